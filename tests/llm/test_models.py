"""Trained operators: held-out accuracy, defined results, and the pipeline."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_exact import SCHEMA, corpus, table
from wordlake.llm import language_id, line_crf, quality_rules
from wordlake.llm.queries import QUERIES
from wordlake.llm.training import bounded_sample


def test_language_accuracy_on_held_out_rows(spark):
    got = QUERIES["op1_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95 and all(0 <= r.score <= 1 for r in got)


def test_language_defined_results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    model = language_id.train(docs)
    odd = table(spark, [(1, None), (2, ""), (3, "123 !!"), (4, "the and of that"), (4, "the and of that"), (None, "der die das und")])
    got = language_id.predict(odd, model).collect()
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3 and got[3].lang_pred == "en" and got[5].lang_pred == "de"
    assert language_id.predict(table(spark, []), model).count() == 0
    none = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(odd, none).collect()} == {"und"}
    one = language_id.train(docs.filter("lang = 'en'"))
    assert language_id.predict(odd, one).collect()[3][-3:] == ("en", 1.0, False)


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 8, 20):
        code = language_id.codewords(n)
        far = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert far >= 1 if n == 2 else far >= 2 and len({tuple(c) for c in code}) == n


def labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")


def ranked(rows):
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    return np.mean([g > b for g in good for b in bad])


def test_line_crf_on_held_out_rows(spark):
    got = QUERIES["op10_line_crf"](spark, SF).join(labelled(spark)[1], "doc_id").filter("held_out").collect()
    assert ranked(got) > 0.9 and all(r.predicted == (r.score >= 0.3) for r in got)


def test_quality_rules_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = quality_rules.train(docs, labels.filter("doc_id % 3 <> 0"))
    got = quality_rules.judge(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    assert ranked(got) > 0.9


def test_quality_defined_results(spark):
    docs, labels = labelled(spark)
    odd = table(spark, [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "x\n" * 3000)])
    crf = line_crf.train(docs, labels)
    scores = [r.score for r in line_crf.score_lines(odd, crf).collect()]
    assert scores[:3] == [crf.prior] * 3 and all(0 <= s <= 1 for s in scores)
    for none in (labels.limit(0), labels.filter("quality = 1")):
        assert line_crf.train(docs, none).emit is None and quality_rules.train(docs, none).weights is None
    assert line_crf.score_lines(odd, line_crf.train(docs, labels.limit(0))).first().score == 0.5
    assert line_crf.score_lines(table(spark, []), crf).count() == 0 and quality_rules.judge(table(spark, []), quality_rules.Model(None)).count() == 0


def test_forward_backward_against_all_paths():
    import itertools

    rng = np.random.RandomState(1)
    counts = np.array([3, 1, 4])
    score, move, start = rng.randn(8, 2), rng.randn(2, 2), rng.randn(2)
    got, pairs = line_crf.forward_backward(score, counts, move, start)
    total, at = np.zeros((2, 2)), 0
    for n in counts:
        weight, mass, sums, moves = 0.0, np.zeros((n, 2)), 0.0, np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(start[path[0]] + sum(score[at + i, s] for i, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            sums += w
            for i, s in enumerate(path):
                mass[i, s] += w
            for a, b in zip(path, path[1:]):
                moves[a, b] += w
        assert np.allclose(got[at : at + n], mass / sums)
        total += moves / sums
        at, weight = at + n, weight
    assert np.allclose(pairs, total)


def test_long_chains_against_the_plain_recursion():
    rng = np.random.RandomState(4)
    for n in (1, 2, 3, 7, 64, 333):
        score, move, start = rng.randn(n, 2) * 3, rng.randn(2, 2), rng.randn(2)
        assert np.allclose(line_crf.long_marginals(score, move, start), line_crf.forward_backward(score, np.array([n]), move, start)[0])


def test_texts_of_many_lines_are_scored_as_whole(monkeypatch):
    rng = np.random.RandomState(6)
    model = line_crf.Model(rng.randn(1 + 3 * line_crf.OWN, 2), rng.randn(2, 2), rng.randn(2), 0.4, 1.5, 0.2)
    lines = ["", "A line. With words, 12 of them!", "a line", "#### $$", "über ß", "  "]
    texts = ["\n".join(lines[i] for i in rng.randint(0, 6, n)).encode() for n in (1, 3, 9, 40, 101)] + [b"\n" * 30, b"", b"x"]
    whole = line_crf.document_scores(texts, model)
    monkeypatch.setattr(line_crf, "LINES", 8)
    parts = line_crf.document_scores(texts, model)
    assert np.allclose(whole[0], parts[0]) and all(np.allclose(a, b) for a, b in zip(whole[1], parts[1], strict=True))


def test_line_crf_query_against_its_model_text_by_text(spark):
    """Every row of the query, scored by sums over the plain recursion for its text alone."""
    docs, labels = labelled(spark)
    model = line_crf.train(docs, labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for r in QUERIES["op10_line_crf"](spark, SF).collect():
        x, counts, length = line_crf.line_features([texts[r.doc_id]])
        good = line_crf.forward_backward(x @ model.emit, counts, model.move, model.start)[0][:, 1]
        share = (length * good).sum() / max(1, length.sum())
        odds = np.log(np.clip(share, 1e-6, 1 - 1e-6)) - np.log1p(-np.clip(share, 1e-6, 1 - 1e-6))
        expected = 1 / (1 + np.exp(-(model.slope * odds + model.offset))) if length.sum() else model.prior
        assert abs(r.score - expected) < 1e-6 and r.predicted == (r.score >= 0.3)


def test_language_query_against_codewords_one_by_one(spark):
    """Every row of the query by the definition: the codeword of least weighted loss."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3)
    model = language_id.train(docs.filter("h <> 1").select("text", "lang"))
    rows = {r.doc_id: r for r in docs.collect()}
    for r in QUERIES["op1_language_id"](spark, SF).collect():
        text = rows[r.doc_id].text or ""
        assert r.held_out == (rows[r.doc_id].h == 1)
        if not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        count = np.zeros(language_id.SIZE)
        for key in language_id.ngram_keys(text).tolist():
            count[key] += 1
        x = np.sqrt(count) / np.sqrt(count.sum())
        margin = x @ model.weights + model.bias
        loss = [sum(t * np.log1p(np.exp(-m * c)) for m, c, t in zip(margin, code, model.trust, strict=True)) for code in model.codes]
        odds = np.exp(-np.array(loss))
        assert r.lang_pred == model.languages[int(np.argmin(loss))] and abs(r.score - odds.max() / odds.sum()) < 1e-3


def test_quality_query_against_its_model_text_by_text(spark):
    docs, labels = labelled(spark)
    model = quality_rules.train(docs, labels)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for r in QUERIES["op7_quality_rules"](spark, SF).collect():
        base, x = quality_rules.describe([texts[r.doc_id]])
        score = model.score(x)[0]
        assert abs(r.score - score) < 1e-4 and (r.kept == (not r.base_failed and score >= 0.5) or abs(score - 0.5) < 1e-4)


def test_samples_count_copies_once_and_are_bounded(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("lang"), F.when(F.col("id") < 3000, "the same text").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    sample = bounded_sample(rows, "lang", 50)
    assert len(sample) == len(set(sample)) <= 200 and len(sample) > 40
    whole = bounded_sample(rows, "lang", 10_000)
    assert len(whole) == 1002 and ("a", "the same text") in whole and ("b", "the same text") in whole


def test_language_stage_keeps_clashing_columns(spark):
    docs = table(spark, [(1, "the and of that is"), (2, "55")]).withColumn("lang", F.lit("en"))
    kept = corpus_pipeline.keep_known_languages(spark, docs, SF)
    assert kept.columns == docs.columns and [(r.doc_id, r.score, r.lang_pred) for r in kept.collect()] == [(1, 0.5, "q")]


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], ", ".join(SCHEMA.split(", ")[:5]))


def test_pipeline_stages(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    real = spark.read.parquet(f"{SF}/documents.parquet")
    docs = real.unionByName(documents(spark, [(10_001, "123 456"), (10_002, None)])).unionByName(real.filter("doc_id = 3").withColumn("doc_id", F.lit(10_003).cast("long")))
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, SF)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns and not ids & {10_001, 10_002} and len(ids) >= 0.95 * real.count()
    unique = dict(corpus_pipeline.STAGES)["near_dup"](spark, docs, SF)
    ids = {r.doc_id for r in unique.collect()}
    assert unique.columns == columns and 10_003 not in ids and 3 in ids
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0, name


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls in any column, repeated rows, shared and missing ids, and columns with the operators' own names."""
    stages = dict(corpus_pipeline.STAGES)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first().text
    passage = " ".join(f"p{i}" for i in range(60))
    one, two = "the words of one text that is short " * 2, "and then of another that is not alike " * 2
    rows = [(1, None), (2, ""), (3, one), (3, one), (3, two), (4, one.upper()), (None, two), (None, "alone"), (5, "x " + passage), (6, passage + " y"), (7, "before " + item + " after")]
    docs = table(spark, rows).withColumn("node", F.lit(None).cast("long")).withColumn("copy", F.lit("mine"))
    out = {name: stages[name](spark, docs, SF) for name in ("language_id", "near_dup", "suffix_dedup", "decontaminate")}
    for name, df in out.items():
        assert df.columns == docs.columns and {r["copy"] for r in df.collect()} <= {"mine"}, name
    texts = {name: sorted((str(r.doc_id), (r.text or "")[:12]) for r in df.collect()) for name, df in out.items()}
    assert texts["near_dup"] == sorted([("1", ""), ("2", ""), ("3", one[:12]), ("3", two[:12]), ("None", "alone"), ("5", "x p0 p1 p2 p3"[:12]), ("7", f"before {item}"[:12])])
    assert ("6", "y") in texts["suffix_dedup"] and len(texts["suffix_dedup"]) == len(rows)
    assert len(texts["decontaminate"]) == len(rows) - 1 and "7" not in {d for d, _ in texts["decontaminate"]}
    assert not {"1", "2"} & {d for d, _ in texts["language_id"]}
    packed = stages["pack"](spark, docs, SF).groupBy("sequence_id").count()
    assert packed.filter("count > 1").count() == 0


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and len({r.sequence_id for r in out}) == len(out)
    per = {}
    for r in out:
        per.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    for (_, n), pieces in per.items():
        assert sum(x for _, x in pieces) == n and sorted(pieces)[0][0] == 0
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dup", "suffix_dedup", "decontaminate", "pack"]


def test_corpus_helper_has_odd_rows():
    assert {None, ""} <= {t for _, t in corpus()}
