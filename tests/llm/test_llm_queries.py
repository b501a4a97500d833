"""Registered queries of the document operators, next to their SQL or a brute-force version."""

import collections
import math
import os
import re
import zlib

import numpy as np
import pytest
import xxhash
from check import compare, duck

from riskframe.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, con, name):
    if name not in QUERIES:
        pytest.skip("registered elsewhere")
    ok, message, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, message


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


def test_op1_ranks_held_out_toxic_documents_first(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(duck(sf).execute("SELECT doc_id, toxic FROM labels").fetchall())
    rows = QUERIES["op1_toxicity"](spark, sf).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    scored = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    bad = [s for s, y in scored if y]
    good = [s for s, y in scored if not y]
    area = sum((a > b) + (a == b) / 2 for a in bad for b in good) / (len(bad) * len(good))
    assert area > 0.8
    assert sum(r["predicted"] for r in rows) > 5


def test_op4_counts_as_the_library_does(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for doc_id, text in docs:
        n = len(tool.encode(text or "", add_special_tokens=False).ids)
        want[doc_id] = (len((text or "").encode()), n, n > 512)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op4_token_counts"](spark, SF).collect()}
    assert got == want


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, radius):
    """doc_id to smallest doc_id reachable, by comparing all pairs."""
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_op7_links_as_all_pairs_do(spark, docs):
    prints = {d: simhash(t) for d, t in docs}
    least = grouped(prints, 3)
    want = {d: (f"{prints[d]:016x}", least[d]) for d in prints}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash"](spark, SF).collect()}
    assert got == want
    assert len(set(least.values())) < len(least)


def test_op8_matches_counts_of_all_texts(spark, docs):
    from riskframe.llm.language_model import STRENGTH

    end, start = object(), object()
    tokens = {d: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), end] for d, t in docs}
    train = [d for d in tokens if zlib.crc32(str(d).encode()) % 10]
    one = collections.Counter(w for d in train for w in tokens[d])
    two = collections.Counter(p for d in train for p in zip([start, *tokens[d]], tokens[d]))
    n, v = sum(one.values()), len(one)
    history = collections.Counter({w: c for w, c in one.items() if w is not end}) + collections.Counter({start: len(train)})
    rows = QUERIES["op8_language_model"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        mine = tokens[r["doc_id"]]
        base = [(one[w] + 0.1) / (n + 0.1 * (v + 1)) for w in mine]
        full = [
            (two[h, w] + STRENGTH * b) / (history[h] + STRENGTH) if h is start or one[h] else b
            for h, w, b in zip([start, *mine], mine, base)
        ]
        assert r["held_out"] == (r["doc_id"] not in set(train))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(mine), sum(one[w] > 0 for w in mine), n)
        assert math.isclose(r["base_score"], sum(map(math.log10, base)), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(map(math.log10, full)), rel_tol=1e-9)


def test_op9_pieces_are_whole_and_sequences_gapless(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for doc_id, text in docs:
        ids = np.array([*tool.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[doc_id, k] = (at, len(part), zlib.crc32(part.tobytes()))
    rows = QUERIES["op9_packing"](spark, SF).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= math.ceil(total / 2048) + 1


def test_pipeline_keeps_what_each_stage_keeps(spark, con, docs):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    base = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    mild = stages["toxicity"](spark, base, SF)
    assert mild.columns == base.columns
    kept = {r["doc_id"]: r["text"] for r in mild.collect()}
    insults = {"idiot", "moron", "scum", "trash"}
    rude = {d for d, t in docs if sum(w in insults for w in re.findall("[a-z]+", lower(t))) > 2}
    assert not rude & set(kept)
    assert len(kept) > 0.8 * len(docs)

    single = stages["near_duplicates"](spark, base, SF)
    least = grouped({d: simhash(t) for d, t in docs}, 3)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(least.values()))

    clean = stages["decontamination"](spark, base, SF)
    want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op2_decontamination']}) WHERE NOT contaminated").fetchall()}
    assert {r["doc_id"] for r in clean.collect()} == want

    private = stages["personal_data"](spark, base, SF)
    assert private.columns == base.columns
    spans = dict(con.execute(f"SELECT doc_id, spans FROM ({ORACLES['op6_pii']})").fetchall())
    texts = dict(docs)
    for r in private.collect():
        text, out, at = texts[r["doc_id"]] or "", "", 0
        found = sorted((int(s), -int(e), k) for k, s, e in (x.split(":") for x in spans[r["doc_id"]].split(",") if x))
        for start, end, kind in found:
            if start >= at:
                out, at = out + text[at:start] + f"<{kind}>", -end
        assert (r["text"] or "") == out + text[at:]

    rows = QUERIES["pipeline"](spark, SF).collect()
    assert rows and {r["doc_id"] for r in rows} <= set(kept)
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"


def test_stages_take_damaged_and_clashing_columns(spark, tmp_path):
    import corpus_pipeline
    from pyspark.sql import functions as F

    rows = [(1, "An idiot and a moron wrote this. " * 3), (2, None), (3, ""), (None, "no id"), (4, "mail a@b.example.com now"), (4, "mail a@b.example.com now"), (5, "word " * 30000), (6, "mail a@b.example.com now")]
    names = ["_score", "_spans", "_words", "_items", "_fp", "_row", "row", "_found_email", "_pii_email", "block", "rank", "task"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"), *[F.lit(i).alias(n) for i, n in enumerate(names)])
    folder = str(tmp_path)
    spark.createDataFrame([(1, 0, 1), (4, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no id"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for kept in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            before, kept = kept, stage(spark, kept, folder)
            if name != "packing":
                assert kept.columns == docs.columns
            if name == "near_duplicates" and before.count():
                assert sorted((r["doc_id"] or 0) for r in kept.collect() if r["text"] and "mail" in r["text"]) == [4]
            if name == "personal_data":
                assert {r["text"] for r in kept.collect() if r["text"] and "mail" in r["text"]} <= {"mail <email> now"}
        assert {r["doc_id"] for r in kept.collect()} <= {1, 2, 4, 5}
