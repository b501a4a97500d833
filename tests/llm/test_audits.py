"""Collocations, the filter audit and quality rules against brute force, with damaged and clashing rows."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest

from riskframe.llm import collocations, filter_audit, quality
from riskframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, lang string, part string, mask int, n int, h string, chunk int, total int, key string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def frame(spark, rows):
    """(doc_id, text, lang) rows with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3, 4, "z") for r in rows], CLASH).repartition(3)


def damaged(draw):
    words = ["the", "The", "of", "it", "été", "a|b", "x", "中文", "\U0001f600", "end.", "no,yes", "A", "B:C"]
    texts = [" ".join(draw.choices(words, weights=[9, 3, 6, 4, *[1] * 9], k=draw.randint(1, 60))) for _ in range(150)]
    texts = [t.replace(" ", draw.choice([" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r\n", "  ", "\x1c"]), draw.randint(0, 4)) for t in texts]
    texts += [None, "", " \t\n", ".", "the " * 30_000, "of\nthe\n" * 9_000, *texts[:40], *texts[:7] * 30]
    rows = [(i, t, draw.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    return [*rows, *rows[:5], (None, "the of it", "en"), (None, "the of it", None), (3, "another text", "fr")]


# --- collocations ---


def phrases(rows, least):
    """As stated: counts over pieces, cuts in whole numbers, what longer candidates hide, ranks."""
    count = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        mine = count["und" if lang is None else lang]
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                mine.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, mine in count.items():
        n = sum(c for p, c in mine.items() if len(p) == 1)
        candidates = {p: c for p, c in mine.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in candidates.items():
            if any(100 * c >= 50 * a for q, c in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            cuts = [(1_000_000 * a * a // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found), 1)]
    return sorted(out)


@pytest.mark.parametrize("least", [10, 2])
def test_collocations_of_damaged_rows(spark, least):
    rows = damaged(random.Random(11))
    got = collocations.mine(frame(spark, rows), least=least).collect()
    assert sorted(tuple(r) for r in got) == phrases(rows, least)
    assert len(got) > 20
    assert collocations.mine(frame(spark, rows).limit(0)).count() == 0
    assert collocations.mine(frame(spark, [(1, None, None), (2, " . ", "en")])).count() == 0


def test_collocations_with_small_blocks_and_buckets(spark, monkeypatch):
    rows = damaged(random.Random(12))
    for name, value in (("KEPT_PIECES", 20), ("KEPT_WORDS", 200), ("BUCKET", 5000), ("FAN", 4)):
        monkeypatch.setattr(collocations, name, value)
    got = collocations.mine(frame(spark, rows), least=3, top=15).collect()
    assert sorted(tuple(r) for r in got) == [r for r in phrases(rows, 3) if r[1] <= 15]


def test_chunks_cover_each_phrase_once():
    draw = random.Random(3)
    pieces = [[draw.choice("abcdefgh").encode() for _ in range(draw.randint(1, 60))] for _ in range(300)]
    parts = collections.defaultdict(list)
    for number, text, size, own in collocations.chunks(pieces, collocations._Hashes(), trigger=3):
        assert size == len(text.split())
        parts[number].append((text.split(), own))
    for number, piece in enumerate(pieces):
        for k in (1, 2, 3):
            counted = collections.Counter()
            for words, own in parts[number]:
                counted.update(tuple(words[i : i + k]) for i in range(own) if i + k <= len(words))
            assert counted == collections.Counter(tuple(piece[i : i + k]) for i in range(len(piece) - k + 1))
    assert list(collocations.chunks([], collocations._Hashes())) == []
    # Where a passage stands does not change its inner chunks.
    passage = [f"w{i}".encode() for i in range(200)]
    inside = {c[1] for c in list(collocations.chunks([passage], collocations._Hashes()))[1:-1]}
    moved = {c[1] for c in collocations.chunks([[b"x", b"y", *passage, b"z", b"x"]], collocations._Hashes())}
    assert len(inside) > 5 and inside <= moved


def test_scores_beyond_64_bits_are_exact(spark):
    draw = random.Random(7)
    rows = []
    for _ in range(500):
        a = draw.randint(10, 10**13)
        rows.append((a, draw.randint(a, 10**14), draw.randint(a, 10**14)))
    rows += [(10**15, 10**15, 10**15), (10**15 - 1, 10**15, 10**15), (7, 7, 7)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = df.select("*", collocations._score(df.a, df.l, df.r).alias("score")).collect()
    assert [r["score"] for r in got] == [1_000_000 * a * a // (x * y) for a, x, y in rows]


# --- filter audit ---


def failures(rows):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, lang in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = (
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            bool(re.search("[#$%&*|]", t)),
            i is not None and t in least and least[t] < i,
        )
        out.append((i, lang or "", {f for f, x in zip("ABCDE", fails) if x}))
    return out


def test_audit_follows_every_document(spark):
    rows = damaged(random.Random(13))
    labels = [(0, 1, 0), (1, 0, 1), (1, 1, None), (2, None, None), (5, 1, 1), (None, 1, 1), *[(i, i % 2, i % 3 == 0) for i in range(6, 200)]]
    table = spark.createDataFrame([(i, q, None if x is None else int(x)) for i, q, x in labels], "doc_id long, quality int, toxic int")
    said = collections.defaultdict(set)
    for i, q, x in labels:
        if i is not None:
            said[i] |= {n for n, v in (("good", q), ("toxic", x)) if v}
    judged = failures(rows)
    want = {}
    removed_by = collections.Counter()
    for order in itertools.permutations("ABCDE"):
        for lang in {x for _, x, _ in judged}:
            left = [(i, f) for i, x, f in judged if x == lang]
            gone = []
            for step, letter in enumerate(order, 1):
                out = [(i, f) for i, f in left if letter in f]
                late = sum(letter in f for _, f in gone)
                left, gone = [(i, f) for i, f in left if letter not in f], gone + out
                alone = sum(f == {letter} for _, x, f in judged if x == lang)
                lost = [sum(n in said[i] for i, _ in out if i is not None) for n in ("good", "toxic")]
                want[lang, "".join(order), step] = (len(left), len(out), late, alone, *lost)
                removed_by[lang, letter] += len(out)
    got = filter_audit.audit(frame(spark, rows), table).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in got} == want
    assert len(got) == len(want) and any(w[4] for w in want.values())
    assert all(r["shapley"] == removed_by[r["part"], r["filter_order"][r["step"] - 1]] for r in got)
    assert filter_audit.audit(frame(spark, rows).limit(0), table).count() == 0
    assert filter_audit.audit(frame(spark, rows), table.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_audit_joins_hashes_by_shuffle_beyond_the_bound(spark, monkeypatch):
    rows = damaged(random.Random(14))
    table = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    small = {tuple(r) for r in filter_audit.audit(frame(spark, rows), table).collect()}
    monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in filter_audit.audit(frame(spark, rows), table).collect()} == small


# --- quality rules ---


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_measures_of_damaged_rows(spark):
    rows = [r for r in damaged(random.Random(15)) if r[0] is not None]
    got = quality.judge(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got) == sorted((i, *base(t)) for i, t, _ in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality.judge(frame(spark, rows).limit(0)).count() == 0
    (alone,) = quality.judge(frame(spark, [(None, None, None)])).collect()
    assert (alone["doc_id"], alone["n_words"], alone["kept"], alone["word_distance"]) == (None, 0, False, None)


def plain_distance(p, q):
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    entropy = lambda x: -sum(v * math.log2(v) for v in x if v)
    return math.sqrt(max(0.0, entropy(m) - (entropy(p) + entropy(q)) / 2))


def test_distances_of_the_query(spark):
    """All documents of sf0.001 against references made by hand."""
    import duckdb

    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, ''), lang FROM '{SF}/documents.parquet'").fetchall()
    fold = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    by_lang = collections.defaultdict(collections.Counter)
    shapes = collections.defaultdict(collections.Counter)
    kinds = [r"[a-z]", r"[A-Z]", r"[0-9]", r"[\x20\x09-\x0D]", r"[.,;:!?'\"()-]", r"[#$%&*+/<=>@\[\\\]^_`{|}~]", r"[^\x00-\x7F]", r"[\x00-\x08\x0E-\x1F\x7F]"]

    def shape(text):
        return np.array([len(re.findall(k, text)) for k in kinds], float)

    for _, text, lang in docs:
        by_lang[lang].update(fold.findall(lower(text)))
        shapes[lang].update(dict(enumerate(shape(text))))
    got = {r["doc_id"]: r for r in QUERIES["op13_quality"](spark, SF).collect()}
    assert len(got) == len(docs)
    judged = 0
    for i, text, lang in docs:
        r = got[i]
        assert tuple(r[c] for c in COLUMNS) == base(text)
        total = sum(by_lang[lang].values())
        far = False
        if total < quality.LEAST_REFERENCE:
            assert r["character_distance"] is None and r["word_distance"] is None
        else:
            if len(text) >= 300:
                judged += 1
                want = plain_distance(shape(text), np.array([shapes[lang][k] for k in range(8)], float))
                assert math.isclose(r["character_distance"], want, abs_tol=1e-7)
                far |= want > 0.3
            words = fold.findall(lower(text))
            if len(words) >= 50:
                common = sorted(w for w, c in by_lang[lang].items() if c * 200 >= total)
                mine = collections.Counter(words)
                p = np.array([mine[w] for w in common], float)
                q = np.array([by_lang[lang][w] for w in common], float)
                want = plain_distance(np.append(p, len(words) - p.sum()), np.append(q, total - q.sum()))
                assert math.isclose(r["word_distance"], want, abs_tol=1e-7)
                far |= want > 0.15 + 2 / math.sqrt(len(words))
        assert r["kept"] == (not r["base_failed"] and not far)
    assert judged > 50


def test_quality_keeps_good_documents_and_drops_bad_ones(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = [r for r in QUERIES["op13_quality"](spark, sf).collect() if not r["base_failed"]]
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1]
    bad = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(good) > 0.99 * len(good) and sum(bad) < 0.5 * len(bad)


def test_references_joined_by_shuffle(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = {tuple(r) for r in quality.judge(df).collect()}
    monkeypatch.setattr(quality, "BROADCAST_LANGS", 0)
    assert {tuple(r) for r in quality.judge(df).collect()} == want
