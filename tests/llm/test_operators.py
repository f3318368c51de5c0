"""Corpus operators against brute force on small rows, and their defined cases."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from martline.llm import decontaminate, jaccard_join, language_id, licenses, line_dedup, lm_scoring, mixing, quality_classifier, quality_rules, suffix_dedup

PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies string, rank int"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    base = " ".join(f"w{i}" for i in range(60))
    texts = [PASSAGE + " tail words here", base, base, base.replace("w30", "other"), "", None, "   ", PASSAGE + "\n" + base + "\n" + PASSAGE, "x" * 300 + " Ünïcode Straße", "x" * 120, "ab " * 40, "Released under the MIT License.\nthe end"]
    rows = [(i, t, "en" if i % 2 else "de", None if i % 3 == 0 else f"s{i % 3}", 0, "clash", 1) for i, t in enumerate(texts)]
    rows += [rows[1], (None, PASSAGE, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], SCHEMA)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_suffix_dedup(docs, empty, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(docs).collect())
    least, rows = {}, [(i, (t or "").encode()) for i, t in pairs(docs)]
    key = lambda i: float("inf") if i is None else i
    for i, b in rows:
        for k in range(len(b) - 49):
            least[b[k : k + 50]] = min(key(i), least.get(b[k : k + 50], float("inf")))
    want = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if least[b[k : k + 50]] < key(i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        want.append((str(i), len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


@pytest.mark.parametrize("block", [2, 384])
def test_jaccard_join(docs, empty, block):
    got = {(str(r.doc_id), r.key): (r.class_id, r.n_links) for r in jaccard_join.similar_groups(docs, block=block).collect()}
    rows = pairs(docs)
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    for n, (i, t) in enumerate(rows):
        links = sum(1 for m, s in enumerate(sets) if m != n and sets[n] and s and len(s & sets[n]) >= 0.8 * len(s | sets[n]))
        assert got[str(i), hashlib.md5((t or "").encode()).hexdigest()][1] == links, i
    assert jaccard_join.jaccard_join(empty).count() == 0


def test_keep_one_of_each(spark, docs):
    kept = [r.doc_id for r in jaccard_join.keep_one_of_each(docs.where("doc_id in (1, 2, 3)").dropDuplicates(["doc_id"])).collect()]
    links = {r.doc_id: r.class_id for r in jaccard_join.similar_groups(docs.where("doc_id in (1, 2, 3)")).collect()}
    assert sorted(kept) == sorted(set(links.values()))


def test_bands_reach_recall():
    for s in (0.5, 0.8, 0.9):
        b, r = jaccard_join.choose_bands(s, 0.99, 256)
        assert 1 - (1 - s**r) ** b >= 0.99


def test_lm_scoring(docs, empty, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK", 200)
    words = {(i, t): re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + [None] for i, t in pairs(docs)}
    counts = collections.Counter(w for i, t in pairs(docs) if not lm_scoring.held_out(i) for w in words[i, t])
    got = lm_scoring.score(docs).collect()
    assert len(got) == len(pairs(docs)) and {r.train_tokens for r in got} == {sum(counts.values())}
    tokens = collections.Counter((str(i), len(words[i, t]), sum(counts[w] > 0 for w in words[i, t])) for i, t in pairs(docs))
    assert tokens == collections.Counter((str(r.doc_id), r.n_tokens, r.n_known) for r in got)
    assert all(r.score <= 0 and r.base_score < 0 for r in got) and lm_scoring.score(empty).count() == 0
    # a filter too large to broadcast is probed where it is, with the same scores
    assert sorted(map(str, got)) == sorted(map(str, lm_scoring.score(docs, filter_bytes=0).collect()))
    assert lm_scoring.score(empty, filter_bytes=0).count() == 0


def test_line_dedup(docs, empty):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[7].text == "" or PASSAGE in got[7].text.split("\n")  # the base line and the second passage go
    assert [(s.start, s.end) for s in got[2].removed] == [(0, len(pairs(docs)[2][1]))] and got[2].text == ""
    assert got[5].text is None and got[2].copies == "clash" and got[0].removed == []
    assert line_dedup.dedup_lines(empty).count() == 0


def test_decontamination(spark, docs, empty):
    bench = spark.createDataFrame([(1, PASSAGE), (2, "tail"), (3, ""), (None, None)], "item_id long, text string")
    got = {str(r.doc_id): r for r in decontaminate.decontamination_report(docs, bench).collect()}
    assert (got["0"].n_hit, got["0"].n_items, got["0"].contaminated) == (15, 2, True)
    assert got["7"].n_hit == 28 and got["1"].n_hit == 0 and got["5"].n_words == 0 and got["None"].n_hit == 14
    assert decontaminate.decontamination_report(empty, bench).count() == 0
    near = decontaminate.proximity(docs, "three one", 3).where("doc_id = 0").collect()
    assert [(r.start, r.end) for r in near] == [(0, 2)]


def test_quality_rules(docs, empty):
    got = {str(r.doc_id): r for r in quality_rules.quality_rules(docs).collect()}
    assert got["10"].n_repeat_words == 40 and got["10"].base_failed and not got["10"].kept
    assert got["5"].n_words == 0 and not got["5"].kept and got["1"].kept
    assert quality_rules.quality_rules(empty).count() == 0


def test_mixing(docs, empty):
    rows = mixing.mix_documents(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    total = sum(r.size for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - total) < 1e-6
    assert rows and sorted(map(str, rows)) == sorted(map(str, mixing.mix_documents(docs).collect()))
    assert mixing.mix_documents(empty).count() == 0


def test_classifier(spark, docs, empty):
    many = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("good plain words "), "id")).otherwise(F.concat(F.lit("spam!! spam!! "), "id")).alias("text"))
    labels = many.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("quality"))
    got = quality_classifier.quality_scores(many, labels).where("held_out").collect()
    assert all(r.predicted == (r.doc_id % 2 == 0) for r in got) and len(got) > 50
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.quality_scores(docs, none).collect()} == {0.5}
    assert quality_classifier.keep_quality(docs, none).columns == docs.columns
    assert quality_classifier.quality_scores(empty, none).count() == 0


def test_language_id(spark, docs, empty):
    de, en = "der die das und nicht mit sich auch", "the and with this that from have not"
    rows = [(i, (de if i % 2 else en) + f" {i}", "de" if i % 2 else "en") for i in range(80)] + [(1000, None, "en"), (1001, "12 -", None)]
    got = {r.doc_id: r for r in language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == ("de" if i % 2 else "en") for i in range(80))
    assert got[1000].lang_pred == got[1001].lang_pred == "und" and got[1001].score == 0
    assert language_id.language_id(empty).count() == 0


def test_licenses(docs, empty):
    got = licenses.license_scan(docs).collect()
    assert [(r.doc_id, r.license, r.start, r.end, r.exact) for r in got] == [(11, "MIT", 0, 31, True)]
    assert licenses.license_scan(empty).count() == 0
