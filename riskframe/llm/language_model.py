"""Log-probabilities of texts under a smoothed n-gram model, read off a weighted backoff automaton.

States are the histories seen in training.  From a state, a token that followed it has an arc of its own;
any other takes the failure arc to the next shorter history, down to the root, which has an arc for every
word and one for all unknown words.  An arc ends in the longest history that the new token makes.  A text is
read from left to right: the walk carries its state and adds up the log-weights of the arcs it takes.  As a state
holds a bounded number of tokens, all positions of a block are walked at once.

Weights come from a hierarchical Dirichlet prior: P(w | h) = (c(h w) + m P(w | shorter h)) / (c(h) + m), so an
arc weighs the whole fraction and a failure arc m / (c(h) + m); the root is additive,
(c(w) + 0.1) / (N + 0.1 (V + 1)).  All sum to 1.

The automaton of a corpus grows with it and is never in one place.  Documents go in blocks of a MB, blocks in
groups of several MB.  A group adds up the counts of its blocks and sends its distinct n-grams, as 64-bit keys with
training counts, to buckets of the key space; a bucket adds up the counts of all groups and sends each group the
totals of its own n-grams.  From these each block takes its own, builds the part of the automaton that its documents
can reach, and walks it.
Keys of two different n-grams fall together with probability n^2 / 2^65 (three in a million for ten million
words); then their counts add up.

Defined results: a null text is empty and has the end token only; repeated rows are scored one by one and
count each; a text of any length is scored whole; with no training text every word is unknown; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise

ORDER = 2
#: Weight of the shorter history, in tokens.
STRENGTH = 200.0
ADDED = 0.1
#: Bytes of text in a block and in a group of blocks, and text whose n-grams share a bucket.
BLOCK_BYTES = 1 << 20
GROUP_BYTES = 8 << 20
BUCKET_BYTES = 12 << 20
#: Text whose n-grams a task of a shuffle reads.
TASK_BYTES = 32 << 20
LEAST_TASKS = 16

_START = np.uint64(xxhash.xxh64_intdigest(b"start of text"))
_END = np.uint64(xxhash.xxh64_intdigest(b"end of text"))


def groups(docs: DataFrame, key: str, text: str, train: str) -> DataFrame:
    """(part, n_bytes, payloads): rows of a task in groups of about GROUP_BYTES of text, each a list of blocks."""

    def payload(batches: list[pa.RecordBatch]) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for batch in batches:
                out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        payloads: list[bytes] = []
        held: list[pa.RecordBatch] = []
        size = in_group = 0

        def group() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([(task << 32) + number], pa.int64()),
                    "n_bytes": pa.array([in_group], pa.int64()),
                    "payloads": pa.array([payloads], pa.list_(pa.binary())),
                }
            )

        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            at = 0
            for end, n in enumerate(sizes.tolist(), 1):
                size += n
                if size >= BLOCK_BYTES:
                    payloads.append(payload([*held, batch.slice(at, end - at)]))
                    in_group, held, size, at = in_group + size, [], 0, end
                    if in_group >= GROUP_BYTES:
                        yield group()
                        number, payloads, in_group = number + 1, [], 0
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            payloads.append(payload(held))
            in_group += size
        if payloads:
            yield group()

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(train).alias("train"))
    return rows.mapInArrow(collect, "part bigint, n_bytes bigint, payloads array<binary>")


def _mix(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


class Block:
    """Tokens of a block and its distinct n-grams, sorted by key."""

    def __init__(self, payload: bytes, order: int):
        table = pa.ipc.open_stream(payload).read_all().combine_chunks()
        self.key = table["key"].combine_chunks()
        self.train = table["train"].to_numpy(zero_copy_only=False).astype(bool)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(table["text"].combine_chunks()))
        flat = lists.flatten()
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        # White space at either end of a text leaves an empty word.
        real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        running = np.concatenate([[0], np.cumsum(real)])
        n_words = running[offsets[1:]] - running[offsets[:-1]]
        coded = flat.filter(pa.array(real)).dictionary_encode()
        names = coded.dictionary.cast(pa.binary()).to_pylist()
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))

        self.lengths = n_words + 1
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        total = int(self.lengths.sum())
        word = np.ones(total, bool)
        word[self.ends - 1] = False
        first = np.full(total, _END, np.uint64)
        first[word] = hashes[coded.indices.to_numpy()]
        in_train = np.repeat(self.train, self.lengths)
        place = np.arange(total) - np.repeat(self.starts, self.lengths)

        #: For each n: positions that end an n-gram, keys sorted, index of each position's key, training counts.
        self.grams: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        keys = first
        for n in range(1, order + 1):
            if n > 1:
                before = np.concatenate([[_START], keys[:-1]])
                if n == 2:
                    before[self.starts] = _START
                keys = _mix(before * np.uint64(0x9E3779B97F4A7C15) + first + np.uint64(n))
            at = np.flatnonzero(place >= n - 2)
            distinct, index = np.unique(keys[at], return_inverse=True)
            counts = np.bincount(index, weights=in_train[at], minlength=len(distinct)).astype(np.int64)
            self.grams.append((at, distinct, index, counts))


def _planes(array: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: the high ones are alike and shrink in the shuffle."""
    return array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in sorted keys; a bucket is a range of the upper 32 bits."""
    upper = [-(-(b << 32) // buckets) << 32 for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(upper, np.uint64)), [len(keys)]]).astype(np.int64)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, np.flatnonzero(first))


def _send(stored: DataFrame, order: int, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payloads in zip(batch.column("part").to_pylist(), batch.column("payloads")):
                found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order)]
                for payload in payloads:
                    for parts, (_, keys, _, counts) in zip(found, Block(payload.as_py(), order).grams):
                        parts.append((keys, counts))
                rows: list[tuple] = []
                for n, parts in enumerate(found, 1):
                    keys, counts = _added(*(np.concatenate(column) for column in zip(*parts)))
                    parts.clear()
                    bounds = _bounds(keys, buckets)
                    for bucket in np.flatnonzero(np.diff(bounds)):
                        mine = slice(bounds[bucket], bounds[bucket + 1])
                        gaps = np.diff(keys[mine], prepend=np.uint64(0))
                        rows.append((n, int(bucket), number, _planes(gaps), _planes(counts[mine].astype(np.uint32))))
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["n", "bucket", "part", "gaps", "counts"],
                )

    return stored.select("part", "payloads").mapInArrow(send, "n int, bucket int, part bigint, gaps binary, counts binary")


def _add_up(group: pa.Table) -> pa.Table:
    """Totals of one bucket, handed to each group of blocks in the order of its keys."""
    pa.default_memory_pool().release_unused()
    numbers = group["part"].to_pylist()
    keys = [np.cumsum(_from_planes(g.as_py(), np.uint64)) for g in group["gaps"]]
    counts = [_from_planes(c.as_py(), np.uint32) for c in group["counts"]]
    distinct, index = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    n_rows = len(numbers)
    seen, tokens = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
    seen[0], tokens[0] = (total > 0).sum(), total.sum()
    return pa.table(
        {
            "part": pa.array(numbers, pa.int64()),
            "n": group["n"],
            "bucket": group["bucket"],
            "totals": pa.array([_planes(total[part]) for part in np.split(index, ends[:-1])], pa.binary()),
            "seen": seen,
            "tokens": tokens,
        }
    )


class Automaton:
    """States, arcs and failure arcs that the texts of a block can reach.

    State 0 is the root, state 1 the start of a text; every other is an n-gram of the block, shorter than
    ``order``, that training has seen.  Words are numbers of the block's distinct words.
    """

    ROOT, START = 0, 1

    def __init__(self, block: Block, totals: list[np.ndarray], n_start: int, root: np.ndarray, strength: float):
        order = len(block.grams)
        _, words, word_at, _ = block.grams[0]
        self.width = len(words)
        # Without histories there is the root alone.
        self.begin = self.START if order > 1 else self.ROOT
        first = np.zeros(len(word_at), bool)
        first[block.starts] = True
        # Per state: its count in training and the state that its failure arc leads to.
        counts, shorter = [np.array([0, n_start])], [np.zeros(2, np.int64)]
        # Per arc: state and word that take it, weight, state it leads to.
        sources, labels, weights, targets = [], [], [], []
        made = 2  # states so far
        states = weight = None  # of the n-grams one token shorter, by position
        for (at, distinct, index, _), total in zip(block.grams, totals):
            n = len(sources) + 1
            # All about an n-gram is read at one position where it ends.
            where = np.empty(len(distinct), np.int64)
            where[index] = at
            if n == 1:
                history = np.zeros(len(distinct), np.int64)
                suffix = history
                own = root
            else:
                before = np.concatenate([[self.START], states[:-1]])
                if n == 2:
                    before[first] = self.START
                history, suffix = before[where], states[where]
                own = (total + strength * weight[where]) / (np.concatenate(counts)[history] + strength)
            seen = total > 0
            state = np.full(len(distinct), self.ROOT)
            if n < order:
                state[seen] = made + np.arange(seen.sum())
                made += int(seen.sum())
                counts.append(total[seen])
                shorter.append(suffix[seen])
            # The root has an arc for every word; an unknown one leads back to it.
            arc = np.ones(len(distinct), bool) if n == 1 else seen
            sources.append(history[arc])
            labels.append(word_at[where[arc]])
            weights.append(own[arc])
            targets.append((state if n < order else suffix)[arc])
            by_position = np.zeros(len(word_at), np.int64)
            by_position[at] = state[index]
            states = by_position
            if n == 1:
                weight = own[index]
            else:
                weight = weight.copy()
                weight[at] = own[index]
        size = np.concatenate(counts)
        self.fall = np.log10(strength / (size + strength))
        self.shorter = np.concatenate(shorter)
        self.steps = order - 1
        self.arcs = pa.array(np.concatenate(sources) * self.width + np.concatenate(labels))
        self.weights = np.log10(np.concatenate(weights))
        self.targets = np.concatenate(targets)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-weight of the arcs that each state takes for its word, failure arcs first, and the states they end in."""
        total = np.zeros(len(state))
        arc = np.full(len(state), -1, np.int64)
        left = np.arange(len(state))
        while len(left):
            found = pc.index_in(pa.array(state[left] * self.width + word[left]), value_set=self.arcs)
            found = found.fill_null(-1).to_numpy(zero_copy_only=False)
            arc[left] = found
            left = left[found < 0]
            total[left] += self.fall[state[left]]
            state = state.copy()
            state[left] = self.shorter[state[left]]
        return total + self.weights[arc], self.targets[arc]

    def walk(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of each text.

        A state tells at most the last ``order`` - 1 tokens apart, so all positions of all texts walk at once: each
        carries its state from that many tokens before it, or from the start of its text.
        """
        n = len(words)
        place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        state = np.where(place <= self.steps, self.begin, self.ROOT)
        for back in range(self.steps, 0, -1):
            # A text's first tokens have fewer before them.
            at = np.flatnonzero(place >= back)
            state[at] = self.step(state[at], words[at - back])[1]
        return np.add.reduceat(self.step(state, words)[0], starts)


def score(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    train: str = "train",
    order: int = ORDER,
    strength: float = STRENGTH,
    added: float = ADDED,
) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``train`` is a boolean column: the model is learnt from the rows where it is true.
    """
    if order < 1 or not strength > 0:
        raise ValueError("order must be 1 or more and strength positive")
    stored = materialise(groups(docs, key, text, train), "lm-groups")
    size = stored.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    # Tasks in proportion to the text, so that none reads more on a larger corpus.
    tasks = max(LEAST_TASKS, math.ceil(size / TASK_BYTES))
    sent = _send(stored, order, buckets)
    totals = materialise(
        sent.repartition(tasks, "n", "bucket").groupBy("n", "bucket").applyInArrow(_add_up, "part bigint, n int, bucket int, totals binary, seen bigint, tokens bigint"),
        "lm-totals",
    )
    known = totals.where("n = 1").agg(F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    vocabulary, n_train = int(known[0]), int(known[1])
    # Each training text has one end token, so their number is the count of the start history.
    train_docs = docs.where(F.col(train)).count()
    kind = docs.schema[key].dataType.simpleString()

    def walked(here: Block, counts: list[np.ndarray]) -> pa.Table:
        root = (counts[0] + added) / (n_train + added * (vocabulary + 1))
        automaton = Automaton(here, counts, train_docs, root, strength)
        words = here.grams[0][2]
        scores = automaton.walk(words, here.starts)
        base, seen = root[words], counts[0][words] > 0
        first = here.starts
        return pa.table(
            {
                key: here.key,
                "n_tokens": pa.array(here.lengths, pa.int64()),
                "n_known": pa.array(np.add.reduceat(seen.astype(np.int64), first), pa.int64()),
                "train_tokens": pa.array(np.full(len(first), n_train), pa.int64()),
                "base_score": np.add.reduceat(np.log10(base), first),
                "score": pa.array(scores, pa.float64()),
            }
        )

    def traverse(group: pa.Table, parts: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        payloads = group["payloads"][0]
        # The group's distinct keys again, in the order in which their totals come.
        found: list[list[np.ndarray]] = [[] for _ in range(order)]
        if len(payloads) > 1:
            for payload in payloads:
                for keys, (_, distinct, _, _) in zip(found, Block(payload.as_py(), order).grams):
                    keys.append(distinct)
        own = [np.unique(np.concatenate(keys)) if keys else None for keys in found]
        found.clear()
        sent: dict[int, list[tuple[int, np.ndarray]]] = {}
        for n, bucket, data in zip(parts["n"].to_pylist(), parts["bucket"].to_pylist(), parts["totals"]):
            sent.setdefault(n, []).append((bucket, _from_planes(data.as_py(), np.int64)))
        # A group of empty texts has no n-gram of three or more.
        none = [(0, np.zeros(0, np.int64))]
        totals_of = [np.concatenate([c for _, c in sorted(sent.get(n, none), key=lambda x: x[0])]) for n in range(1, order + 1)]
        sent.clear()
        tables = []
        for payload in payloads:
            here = Block(payload.as_py(), order)
            counts = [
                total if keys is None else total[np.searchsorted(keys, distinct)]
                for keys, total, (_, distinct, _, _) in zip(own, totals_of, here.grams)
            ]
            tables.append(walked(here, counts))
            pa.default_memory_pool().release_unused()
        return pa.concat_tables(tables)

    return (
        stored.select("part", "payloads")
        .repartition(tasks, "part")
        .groupBy("part")
        .cogroup(totals.select("part", "n", "bucket", "totals").repartition(tasks, "part").groupBy("part"))
        .applyInArrow(traverse, f"`{key}` {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    )
