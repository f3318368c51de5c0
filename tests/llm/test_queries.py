"""The registered corpus queries and the pipeline on whole test tables, against plain versions of their rules."""

import collections
import math
import re
from zlib import crc32

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from martline.llm import decontaminate, licenses, line_dedup, mixing, quality_classifier, queries

SF = "/root/testdata/sf0.001"
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        c.execute(f"CREATE TABLE {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory, con):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def sentences(text):
    """[line start, line end, [(start, end, words)]] of every line, cut after sentence ends."""
    at, out = 0, []
    for line in (text or "").split("\n"):
        cuts, k = [0], 0
        for m in re.finditer(r"(?:[.!?][\"')\]]*[^\S\n]+|[。！？]+)", line):
            if m.end() < len(line):
                cuts.append(m.end())
        out.append((at, at + len(line), [(at + a, at + b, line[a:b].lower().split()) for a, b in zip(cuts, [*cuts[1:], len(line)])]))
        at += len(line) + 1
    return out


def without_repeated_units(texts):
    """doc_id -> (text that stays, removed (start, end)): every occurrence of a unit but the first loses its segments."""
    places, first = {}, {}
    for i in sorted(texts):
        segments = [x for _, _, line in sentences(texts[i]) for x in line if x[2]]
        runs = set()
        for k in range(len(segments)):
            for step in (1, -1):
                j, n = k, 0
                while 0 <= j < len(segments):
                    n += len(segments[j][2])
                    if n >= line_dedup.MIN_WORDS:
                        runs.add((min(k, j), max(k, j)))
                        break
                    j += step
        for k, j in sorted(runs):
            unit = tuple(w for x in segments[k : j + 1] for w in x[2])
            places.setdefault(i, []).append((unit, k, [x[0] for x in segments[k : j + 1]]))
            first.setdefault(unit, (i, k))
    out = {}
    for i in texts:
        gone = {a for unit, k, starts in places.get(i, ()) if first[unit] != (i, k) for a in starts}
        keep, cut = [], []
        for start, end, line in sentences(texts[i]):
            kept = "".join(texts[i][a:b] for a, b, _ in line if a not in gone) if texts[i] else ""
            spans = []
            for a, b, _ in line:
                if a in gone:
                    spans = spans[:-1] + [(spans[-1][0], b)] if spans and spans[-1][1] == a else spans + [(a, b)]
            if not spans or sum(b - a for a, b in spans) < end - start:
                keep.append(kept)
            cut += spans
        out[i] = (None if texts[i] is None else "\n".join(keep), cut)
    return out


def shingles(text):
    w = SPACE_WORD.findall(text or "")
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def similar(texts):
    """doc_id -> (least id of its group, number of links), by comparing all pairs."""
    ids = sorted(texts)
    sets, root, links = {i: shingles(texts[i]) for i in ids}, {i: i for i in ids}, collections.Counter()

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: (top(i), links[i]) for i in ids}


def quality(texts, labels):
    """doc_id -> score of the trained model, from its numbers a feature."""
    examples = [(int(q > 0), *quality_classifier.sparse(texts[i])) for i, q in sorted(labels) if i in texts and crc32(str(i).encode()) % 3 != 1]
    numbers, bias = quality_classifier.train(examples)
    out = {}
    for i, t in texts.items():
        words = (t or "").split()
        words += [quality_classifier.REPEAT] * sum(a == b for a, b in zip(words, words[1:]))
        f = [x for w in words for x in quality_classifier.features(w)]
        out[i] = 1 / (1 + math.exp(-(bias + (float(np.mean(numbers[f].astype(np.float64))) if f else 0.0))))
    return out


def labels_of(con):
    return con.execute("SELECT DISTINCT doc_id, quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL").fetchall()


def test_quality_classifier_query(spark, con, texts):
    want = quality(texts, labels_of(con))
    got = {r.doc_id: r for r in queries.op2_quality_classifier(spark, SF).collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert r.score == pytest.approx(want[i], abs=1e-4) and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (crc32(str(i).encode()) % 3 == 1)
    held = [(got[i].predicted, q) for i, q in labels_of(con) if got[i].held_out]
    assert sum(p == q for p, q in held) >= 0.9 * len(held) > 0


def test_jaccard_query(spark, texts):
    want = similar(texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op6_jaccard_join(spark, SF).collect()}
    assert got == want and any(n for _, n in want.values())


def test_line_dedup_query(spark, texts):
    want = without_repeated_units(texts)
    got = {r.doc_id: (r.text, [(s.start, s.end) for s in r.removed]) for r in queries.op9_line_dedup(spark, SF).collect()}
    assert got == want and any(cut for _, cut in want.values())


def test_license_query(spark, texts):
    """Every line that holds a template's short notice word for word is found, under that template."""
    found = collections.defaultdict(set)
    for r in queries.op4_license_scan(spark, SF).collect():
        assert 0 <= r.start < r.end <= len(texts[r.doc_id])
        found[r.doc_id].add((r.license, r.start))
    planted = 0
    for i, t in texts.items():
        at = 0
        for line in (t or "").split("\n"):
            for name, passages in licenses.TEMPLATES.items():
                if line.strip() in passages:
                    planted += 1
                    assert (name, at) in found[i], (i, line)
            at += len(line) + 1
    assert planted


def test_lm_query(spark, texts):
    lower = {c: c + 32 for c in range(65, 91)}
    tokens = {i: SPACE_WORD.findall((t or "").translate(lower)) + [None] for i, t in texts.items()}
    counts = collections.Counter(w for i, t in tokens.items() if crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in queries.op7_lm_scoring(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, t in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        assert got[i].base_score == pytest.approx(base, rel=1e-9) and got[i].train_tokens == n
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the model beats its base on held-out text


def test_language_query(spark, con, texts):
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in queries.op8_language_id(spark, SF).collect() if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) > 0


def test_pipeline(spark, con, texts):
    """All five stages, each in its plain form: model scores, all pairs, a table of units, and the SQL of the last two."""
    scores = quality(texts, labels_of(con))
    docs = {i: t for i, t in texts.items() if scores[i] >= 0.5}
    groups = similar(docs)
    docs = {i: t for i, t in docs.items() if groups[i][0] == i}
    cleaned = {i: t for i, (t, _) in without_repeated_units(docs).items()}
    assert 0 < len(cleaned) < len(texts) and cleaned != docs
    c = duckdb.connect()
    c.execute(f"CREATE TABLE benchmark AS SELECT * FROM read_parquet('{SF}/benchmark.parquet')")
    c.execute(f"CREATE TABLE documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    c.execute("CREATE TABLE cleaned (id BIGINT, cleaned VARCHAR)")
    c.executemany("INSERT INTO cleaned VALUES (?, ?)", list(cleaned.items()))
    c.execute("DELETE FROM documents WHERE doc_id NOT IN (SELECT id FROM cleaned)")
    c.execute("UPDATE documents SET text = cleaned FROM cleaned WHERE doc_id = id")
    c.execute(f"CREATE TABLE bad AS SELECT doc_id AS id FROM ({decontaminate.ORACLE}) AS x WHERE contaminated")
    assert c.execute("SELECT COUNT(*) FROM bad").fetchone()[0] > 0
    c.execute("DELETE FROM documents WHERE doc_id IN (SELECT id FROM bad)")
    rel = c.execute(mixing.ORACLE)
    names = [d[0] for d in rel.description]
    want = {r["doc_id"]: r for r in (dict(zip(names, row)) for row in rel.fetchall())}
    got = {r.doc_id: r.asDict() for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert (r["size"], r["source_size"], r["taken"]) == (want[i]["size"], want[i]["source_size"], want[i]["taken"])
        assert r["target"] == pytest.approx(want[i]["target"])
