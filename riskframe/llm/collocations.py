"""Collocations: short phrases whose words stand together more often than their parts suggest.

Counts come from a prefix-free parse.  A text is lower-cased and cut into pieces at punctuation and line ends; in
a piece, every pair of neighbouring words whose hash is a multiple of ``TRIGGER`` is a trigger.  A chunk reaches
from one trigger to the end of the next, so neighbouring chunks overlap by two words and equal passages have equal
chunks wherever they stand.  Distinct chunks with their frequencies are the dictionary.  The phrases of up to three
words that start before a chunk's closing trigger lie inside the chunk, those that start in the trigger belong to
the next one: each occurrence is counted in one chunk.  So phrases are counted once per distinct chunk, weighted by
its frequency.

Counting sends, per task and bucket of phrases, one compressed list of distinct phrases with their sums; buckets
are dealt by a hash of the whole phrase, so no frequent word, pair or language gathers in one of them, and hold
about ``BUCKET`` phrases whatever the corpus.  Where more than ``FAN`` buckets are needed, lists are dealt in steps and
added up in between, so the number of lists follows the corpus and not its square.  Only phrases with the least frequency leave a bucket: the parts of
a frequent phrase are as frequent as itself, so nothing that a score needs is missing.

Defined results: a null text is empty; a null language is ``und``; empty texts, pieces and tables give nothing;
repeated rows count as often as they occur; a text without any punctuation is one piece of any length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.text import LOWER, UPPER, as_bytes
from riskframe.session import materialise, ship

LONGEST = 3
LEAST = 10
TOP = 2000
#: A longer phrase hides what it contains if it has at least this share of its occurrences, in hundredths.
HIDES = 50
UNKNOWN = "und"
#: One pair of neighbouring words in so many is a trigger, about.
TRIGGER = 8
OVERLAP = LONGEST - 1
#: Pieces and words that a task holds before it hands on their sums, phrases in a bucket, and buckets that a list is
#: dealt to at once (memory, not results).
KEPT_PIECES = 150_000
KEPT_WORDS = 1_000_000
BUCKET = 1_000_000
FAN = 512
#: Rows of a language are ranked in so many parts first.
RANK_PARTS = 64

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes.maketrans(UPPER.encode() + _BREAKS + b"\x09", LOWER.encode() + b"\x0a" * len(_BREAKS) + b"\x20")


def _packed(value: bytes) -> bytes:
    return pa.compress(value, "zstd", asbytes=True)


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = crc32(word)
        return value


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every element of runs of the given sizes: its place in its run, and the size of that run."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes), np.repeat(sizes, sizes)


def chunks(parsed: list[list[bytes]], hashes: dict, trigger: int = TRIGGER) -> Iterator[tuple[int, bytes, int, int]]:
    """(number of the piece, text, words, words before the closing trigger) of the chunks of pieces."""
    sizes = np.fromiter(map(len, parsed), np.int64, len(parsed))
    values = np.fromiter(map(hashes.__getitem__, chain.from_iterable(parsed)), np.uint64, int(sizes.sum()))
    place, size = _spread(sizes)
    # The factor keeps the pair's order; the shift takes bits that depend on both words.
    pair = (values[:-1] * np.uint64(31) + values[1:] >> np.uint64(7)) % np.uint64(trigger) == 0
    cuts = np.flatnonzero(pair & (place[:-1] >= 1) & (place[:-1] < size[:-1] - OVERLAP))
    cuts_of = np.split(place[cuts], np.searchsorted(cuts, np.cumsum(sizes)[:-1])) if len(sizes) else []
    for number, (piece, at) in enumerate(zip(parsed, cuts_of)):
        start = 0
        for cut in at.tolist():
            yield number, b" ".join(piece[start : cut + OVERLAP]), cut + OVERLAP - start, cut - start
            start = cut
        yield number, b" ".join(piece[start:]), len(piece) - start, len(piece) - start


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, chunk, size, own, n): distinct chunks, their words, those before the closing trigger, their frequency."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Equal pieces of a task are parsed once.
        found: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            hashes = _Hashes()
            for name, counts in found.items():
                parsed, weights = [], []
                for piece, n in counts.items():
                    if words := piece.split():
                        parsed.append(words)
                        weights.append(n)
                number, chunk, size, own = list(zip(*chunks(parsed, hashes))) or [()] * 4
                sums = np.array(weights, np.int64)[np.array(number, np.int64)]
                columns = [pa.array([name] * len(chunk), pa.string()), pa.array(chunk, pa.binary()), pa.array(size, pa.int32()), pa.array(own, pa.int32()), pa.array(sums)]
                yield from pa.Table.from_arrays(columns, names=["lang", "chunk", "size", "own", "n"]).to_batches(max_chunksize=20_000)
            found.clear()

        held = 0
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text"))):
                pieces = (value or b"").translate(_FOLD).split(b"\n")
                found.setdefault(name, Counter()).update(pieces)
                held += len(pieces)
                if held >= KEPT_PIECES:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    parsed = rows.mapInArrow(parse, "lang string, chunk binary, size int, own int, n bigint")
    return parsed.groupBy("lang", "chunk", "size", "own").agg(F.sum("n").alias("n"))


class _Block:
    """Words of many chunks of a language as numbers, and the sums of the phrases among them."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.words: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.owned: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []

    def add(self, chunk: list[bytes], size: np.ndarray, own: np.ndarray, n: np.ndarray) -> int:
        flat = b" ".join(chunk).split(b" ")
        self.words.append(np.fromiter(map(self.numbers.__getitem__, flat), np.int64, len(flat)))
        self.sizes.append(size)
        self.owned.append(own)
        self.weights.append(n)
        return len(flat)

    def sums(self, fan: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """(phrases, counts, buckets) of the distinct phrases of each length."""
        vocabulary = pa.array(self.numbers, pa.binary())
        order = pc.sort_indices(vocabulary)
        vocabulary = vocabulary.take(order)
        rank = np.empty(len(vocabulary), np.int64)
        rank[order.to_numpy()] = np.arange(len(vocabulary))
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary.to_pylist()), np.uint64, len(vocabulary))
        words = rank[np.concatenate(self.words)]
        sizes = np.concatenate(self.sizes)
        place, size = _spread(sizes)
        starts = place < np.repeat(np.concatenate(self.owned), sizes)
        weights = np.repeat(np.concatenate(self.weights), sizes)
        # Blocks have fewer than 2^21 words, so three numbers fit into 63 bits.
        bits = max(1, int(len(vocabulary) - 1).bit_length())
        for n in range(1, LONGEST + 1):
            first = np.flatnonzero(starts & (place + n <= size))
            if not len(first):
                continue
            key = words[first]
            for k in range(1, n):
                key = key << bits | words[first + k]
            by_key = np.argsort(key, kind="stable")
            key = key[by_key]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            counts = np.add.reduceat(weights[first[by_key]], new)
            columns = [key[new] >> bits * (n - 1 - k) & (1 << bits) - 1 for k in range(n)]
            mixed = hashed[columns[0]]
            for c in columns[1:]:
                mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + hashed[c]
            mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
            parts = [vocabulary.take(pa.array(c)) for c in columns]
            phrases = pc.binary_join_element_wise(*parts, b" ") if n > 1 else parts[0]
            yield phrases, counts, ((mixed >> np.uint64(33)) % np.uint64(fan)).astype(np.int64)


_SENT = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("size", pa.int64()), ("rows", pa.int64()), ("phrases", pa.binary()), ("counts", pa.binary())])
_SENT_TYPE = "lang string, bucket bigint, size bigint, rows bigint, phrases binary, counts binary"


def _sent(lang: str, phrases: pa.Array, counts: np.ndarray, buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per bucket: its phrases and their counts, compressed."""
    order = np.argsort(buckets, kind="stable")
    phrases, counts, buckets = phrases.take(pa.array(order)), counts[order], buckets[order]
    ends = np.flatnonzero(np.concatenate([buckets[1:] != buckets[:-1], [True]])) + 1
    begins = np.concatenate([[0], ends[:-1]])
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(begins, ends[-1]), pa.int32()), phrases), b"\n")
    for at in range(0, len(ends), 128):
        rows = []
        for i in range(at, min(at + 128, len(ends))):
            blob = joined[i].as_py()
            rows.append((lang, int(buckets[begins[i]]), len(blob), int(ends[i] - begins[i]), _packed(blob), _packed(counts[begins[i] : ends[i]].tobytes())))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT)], schema=_SENT)


def _total(sent: pa.Table | pa.RecordBatch) -> pa.Table:
    """(phrase, n) of the distinct phrases in rows that were sent."""
    phrases, counts = [], []
    for size, rows, blob, numbers in zip(*(sent[c].to_pylist() for c in ("size", "rows", "phrases", "counts"))):
        one = pa.array([pa.decompress(blob, size, "zstd", asbytes=True)], pa.binary())
        phrases.append(pc.split_pattern(one, b"\n").flatten())
        counts.append(np.frombuffer(pa.decompress(numbers, 8 * rows, "zstd", asbytes=True), np.int64))
    table = pa.table({"phrase": pa.chunked_array(phrases, pa.binary()), "n": np.concatenate(counts)})
    return table.group_by("phrase").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})


def _dealt_finer(sums: DataFrame, fan: int, level: int) -> DataFrame:
    """Each bucket of ``sums`` dealt to ``fan`` buckets; lists of several blocks are added up on the way."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            lang, bucket = held[0]["lang"][0].as_py(), held[0]["bucket"][0].as_py()
            total = _total(pa.Table.from_batches(held))
            held.clear()
            phrases = total["phrase"].combine_chunks()
            digest = np.fromiter((xxhash.xxh64_intdigest(p, level) for p in phrases.to_pylist()), np.uint64, len(phrases))
            yield from _sent(lang, phrases, total["n"].to_numpy(), bucket * fan + (digest % np.uint64(fan)).astype(np.int64))

        n, last = 0, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                at = (row["lang"][0].as_py(), row["bucket"][0].as_py())
                if held and (at != last or n >= KEPT_WORDS):
                    yield from flush()
                    n = 0
                last = at
                held.append(row)
                n += row["rows"][0].as_py()
        if held:
            yield from flush()

    near = sums.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    return near.mapInArrow(deal, _SENT_TYPE)


def phrase_counts(parsed: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, n) of all phrases of one to three words with at least ``least`` occurrences."""
    ship(parsed.sparkSession)
    total = parsed.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    buckets = max(1, -(-LONGEST * total // BUCKET))
    fan = min(buckets, FAN)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, _Block] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(blocks):
                for phrases, counts, dealt in blocks.pop(lang).sums(fan):
                    yield from _sent(lang, phrases, counts, dealt)

        held = 0
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            codes, chunk = langs.indices.to_numpy(), batch.column("chunk")
            numbers = [batch.column(c).to_numpy().astype(np.int64) for c in ("size", "own", "n")]
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(codes == code)
                held += blocks.setdefault(lang, _Block()).add(chunk.take(pa.array(mine)).to_pylist(), *(x[mine] for x in numbers))
            if held >= KEPT_WORDS:
                yield from flush()
                held = 0
        yield from flush()

    def merge(sent: pa.Table) -> pa.Table:
        total = _total(sent)
        total = total.filter(pc.greater_equal(total["n"], least))
        lang = pa.array([sent["lang"][0].as_py()] * total.num_rows, pa.string())
        return pa.table({"lang": lang, "phrase": total["phrase"].cast(pa.string()), "n": total["n"]})

    sums = parsed.select("lang", "chunk", "size", "own", "n").mapInArrow(count, _SENT_TYPE)
    level = 1
    while fan < buckets:
        step = min(FAN, -(-buckets // fan))
        sums = _dealt_finer(sums, step, level)
        fan, level = fan * step, level + 1
    return sums.groupBy("lang", "bucket").applyInArrow(merge, "lang string, phrase string, n bigint")


def _score(a: Column, left: Column, right: Column) -> Column:
    """Largest whole number not above a million times a squared over left times right, without rounding."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    above = (F.lit(1_000_000).cast("decimal(7,0)") * (wide[0] * wide[0])).cast("decimal(38,0)")
    return F.call_function("div", above, wide[1] * wide[2])


def rank(counts: DataFrame, totals: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The best phrases of every language from counts (lang, phrase, n) and words per language (lang, total)."""
    words = F.split("phrase", " ")
    known = counts.withColumn("words", words).withColumn("size", F.size("words"))
    candidates = known.where((F.col("size") > 1) & (F.col("n") >= least))
    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.col("size") - 1),
            lambda k: F.array(
                F.struct(k.alias("k"), F.lit(True).alias("left"), F.array_join(F.slice("words", 1, k), " ").alias("part")),
                F.struct(k.alias("k"), F.lit(False).alias("left"), F.array_join(F.slice("words", k + 1, F.col("size") - k), " ").alias("part")),
            ),
        )
    )
    asked = candidates.select("lang", "phrase", F.col("n").alias("a"), F.explode(parts).alias("p")).select("lang", "phrase", "a", "p.*")
    answered = asked.join(counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")), ["lang", "part"])

    def side(k: int, left: bool) -> Column:
        return F.max(F.when((F.col("k") == k) & (F.col("left") == left), F.col("f"))).alias(f"{'l' if left else 'r'}{k}")

    cuts = range(1, LONGEST)
    scored = answered.groupBy("lang", "phrase", "a").agg(*[side(k, left) for k in cuts for left in (True, False)])
    # Cuts that a phrase does not have are null, and least() passes over them.
    best = F.least(
        *[
            F.when(F.col(f"l{k}").isNotNull(), F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
            for k in cuts
        ]
    )
    scored = scored.select("lang", "phrase", "a", best.alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda length: F.transform(F.sequence(F.lit(1), F.col("size") - length + 1), lambda i: F.array_join(F.slice("words", i, length), " ")),
        )
    )
    around = candidates.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    shown = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * HIDES)
    )
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    near = shown.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of every language."""
    ship(docs.sparkSession)
    parsed = materialise(dictionary(docs, text, lang), "chunks")
    totals = parsed.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("total"))
    counts = materialise(phrase_counts(parsed, least), "phrases")
    return rank(counts, totals, least, top)
