"""Odd input for every training-data operator and pipeline stage, brute force for mixing, templates and passages, and plans."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from heliograph.llm import html_text, mixing, near_duplicates, nearest, quality_classifier, quality_rules, sampled_pieces, secret_scan, substring_dedup, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n)]


ODD = [
    (1, None, None, None, None), (None, "a b c d e", "en", "s", 5), (None, None, None, None, None), (None, None, None, None, None), (2, "", "xx", None, 0), (3, "  \n\t", "en", "s", 4),
    (4, " ".join(words(1, 300)), "en", "t", 1), (4, " ".join(words(1, 300)), "en", "t", 1), (6, " ".join(words(1, 300)), "en", "t", 1), (7, " ".join(words(3, 300)), None, "", -1),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty texts, ties and repeated rows."""
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def clash(spark, odd):
    """The same with columns named as operators name theirs."""
    names = ["row_key", "_row_key", "_row", "row", "_key", "key", "gone", "_cuts", "cuts", "_n", "node", "score", "spans", "ids", "ws", "kept", "size", "u", "host", "band"]
    return odd.withColumns({n: F.lit("mine") for n in names})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def carried(df, rows, *names):
    got = df.collect()
    assert len(got) == rows and all(r[n] == "mine" for r in got for n in names)


def test_clashing_names(spark, clash, labels):
    n = len(ODD)
    carried(near_duplicates.keep_one(clash), 8, "_row_key", "_n", "row", "kept")
    carried(substring_dedup.drop_repeats(clash), n, "gone", "_cuts", "row_key")
    carried(quality_rules.quality_rules(clash), n, "row", "ws", "size")
    carried(toxicity.tag_toxicity(clash, labels), n, "_key", "row")
    carried(sampled_pieces.encode_pieces(clash, sampled_pieces.row_key(F.col("doc_id"))), n, "_key", "key")
    carried(secret_scan.redact(clash), n, "key", "band")
    assert mixing.mix(mixing.sized(clash), mixing.source_targets(mixing.sized(clash))).count() == n
    assert quality_classifier.classify(clash, labels).count() == n
    vectors = spark.createDataFrame([(i, [float(i + 1), 1.0], "x", "y") for i in (0, 0, 1, 2)], "vec_id long, embedding array<double>, row string, v string")
    assert nearest.nearest(nearest.usable(vectors), F.col("vec_id") % 100 == 0).count() == 6
    pages = spark.createDataFrame([(1, "http://a.example/", "<p>x</p>", "m", "m")], "page_id int, url string, html string, host string, classes string")
    assert html_text.extract_main_text(pages).first().text == "x"


def test_empty_tables(spark, labels):
    none = spark.createDataFrame([], DOCS)
    assert mixing.mix(mixing.sized(none), mixing.source_targets(mixing.sized(none))).count() == 0
    assert quality_classifier.classify(none, labels).count() == toxicity.tag_toxicity(none, labels).count() == 0
    assert sampled_pieces.encode_pieces(none, F.lit(1)).count() == secret_scan.redact(none).count() == substring_dedup.drop_repeats(none).count() == 0
    assert html_text.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_very_long_text(spark, labels):
    r = random.Random(5)
    some = words(11, 5000)
    text = " ".join(r.choice(some) for _ in range(150_000)) + " " + "z" * 3000  # a megabyte
    docs = spark.createDataFrame([(1, text, "en", "s", 0), (2, text + " end", "en", "s", 0), (3, "short one", "en", "s", 0)], DOCS)
    assert {x.doc_id: x.class_id for x in near_duplicates.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert {x.doc_id: x.n_words for x in quality_rules.quality_rules(docs).collect()} == {1: 150_001, 2: 150_002, 3: 2}
    assert all(x.lossless for x in sampled_pieces.encode_pieces(docs, F.col("doc_id")).collect())
    assert {len(x.text) for x in substring_dedup.drop_repeats(docs).collect() if x.doc_id != 2} == {len(text), 9}
    assert secret_scan.scan(docs).count() >= 0 and quality_classifier.classify(docs, labels).count() == toxicity.tag_toxicity(docs, labels).count() == 3
    page = "<html><body>" + "<div><p>part</p></div>" * 50_000 + "</body></html>"
    assert html_text.main_text(page, None).count("part") == 50_000


def test_long_units_are_drawn_as_short_ones(monkeypatch):
    s = sampled_pieces.Sampler()
    texts = [" ".join(words(2, 30)) + " é一😀▁", "  " * 9 + "x"]
    side = s.encode(texts, [1, 2])
    monkeypatch.setattr(sampled_pieces, "SIDE_BY_SIDE", 1)
    monkeypatch.setattr(sampled_pieces, "WINDOW", 7)
    alone = s.encode(texts, [1, 2])
    assert side[0].tolist() == alone[0].tolist() and side[1].tolist() == alone[1].tolist()


def test_training_reads_documents_in_all_tasks(spark, labels):
    from heliograph.llm.labelled import training_sample

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sample = training_sample(docs.unionByName(docs), labels, "toxic", 5, 0, 30)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "Exchange SinglePartition" in plan.split("Scan parquet")[0]
    rows = sample.collect()
    assert len({r.doc_id for r in rows}) == len(rows) <= 60 and sample.rdd.getNumPartitions() == 1


def brute_mix(docs, targets, seed):
    """Words taken of each (source, id), by a plain walk."""
    out = {}
    for source, (total, target) in targets.items():
        own = [(i, n) for i, s, n in docs if s == source]
        copies = target // total
        rest = target - copies * total
        expected = sum(float(n) * n for _, n in own)
        ranked = []
        for i, n in own:
            u = (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52
            p = max(1e-12, min(1 - 1e-9, rest * n / expected))
            ranked.append((u / (1 - u) / (p / (1 - p)), n, i))
        ranked.sort()
        taken, gap = set(), rest
        for q, n, i in ranked:
            if 0 < n <= gap:
                taken.add(i)
                gap -= n
        while True:
            outs = [0, *{n for _, n, i in ranked if i in taken}]
            ins = [0, *{n for _, n, i in ranked if i not in taken and n > 0}]
            off, x, y = min((abs(gap - (y - x)), x, y) for x in outs for y in ins if x != y) if len(outs) + len(ins) > 2 else (gap, 0, 0)
            if off >= abs(gap) - 1e-6:
                break
            if x:
                taken.remove([i for _, n, i in ranked if n == x and i in taken][-1])
            if y:
                taken.add([i for _, n, i in ranked if n == y and i not in taken][0])
            gap -= y - x
        out |= {(source, i): n * (copies + (i in taken)) for i, n in own}
    return out


def test_mix_against_a_plain_walk(spark):
    r = random.Random(3)
    docs = [(i, r.choice("abc"), r.choice([3, 7, 20, 40, 41, 90, 300])) for i in range(150)]
    totals = {s: sum(n for _, x, n in docs if x == s) for s in "abc"}
    targets = {"a": (totals["a"], totals["a"] * 0.43), "b": (totals["b"], totals["b"] * 1.37), "c": (totals["c"], totals["c"] * 2.0)}
    frame = spark.createDataFrame([(s, n, t) for s, (n, t) in targets.items()], "source string, source_size long, target double")
    got = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, size long"), frame, seed="x").collect()
    assert {(x.source, x.doc_id): x.taken for x in got} == brute_mix(docs, targets, "x")


def test_larger_documents_are_taken_more_often(spark):
    docs = spark.createDataFrame([(i, "a", 10 if i % 2 else 40) for i in range(2000)], "doc_id long, source string, size long")
    targets = spark.createDataFrame([("a", 50_000, 10_000.0)], "source string, source_size long, target double")
    got = mixing.mix(docs, targets).collect()
    share = lambda n: sum(x.taken > 0 for x in got if x.size == n) / 1000
    assert share(40) > 2.5 * share(10) > 0


def test_passages_stay_somewhere(spark):
    r = random.Random(9)
    parts = [" ".join(words(300 + k, 60)) for k in range(8)]
    rows = [(i, " ".join(r.choice(parts + [" ".join(words(1000 + 9 * i + k, 25))]) for k in range(5))) for i in range(40)]
    rows += [(100, parts[0]), (101, parts[0][-150:] + " " + parts[1]), (101, parts[0][-150:] + " " + parts[1]), (None, parts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = substring_dedup.drop_repeats(docs).collect()
    texts, after = [t for _, t in rows], [x.text for x in left]
    assert len(left) == len(rows) and sum(map(len, after)) < 0.7 * sum(map(len, texts))
    for p in parts:
        if any(p in t for t in texts):
            assert any(p[100:-100] in t for t in after)
    again = substring_dedup.drop_repeats(docs).collect()
    assert sorted(map(repr, left)) == sorted(map(repr, again))


def test_template_classes_against_brute_force(spark):
    page = "<html><body><div class='top'><b>Site</b></div><ul>{}</ul><div class='one'><p>Own {}.</p></div><div class='two'><p>More {}.</p><p>Kind words</p></div><p>All rights</p></body></html>"
    pages = [(i, f"http://g.example/{i}", page.format("<li>item</li>" * (i % 4 + 1), i, i)) for i in range(12)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = html_text.templates(df.select(F.lit("g").alias("host"), "url", "html")).collect()
    vectors = defaultdict(lambda: [0] * len(pages))
    for k, (_, _, h) in enumerate(pages):
        for token, n in Counter(html_text._token(path, text) for path, text, *_ in html_text.tokens(h)).items():
            vectors[token][k] = n
    classes = defaultdict(set)
    for token, v in vectors.items():
        if sum(map(bool, v)) >= 6:
            classes[tuple(v)].add(token)
    assert {frozenset(c.tokens) for c in got[0].classes} == {frozenset(c) for c in classes.values() if len(c) > 1}
    texts = {r.page_id: r.text for r in html_text.extract_main_text(df).collect()}
    assert all(t == f"Own {i}.\nMore {i}." for i, t in texts.items())


def test_rounds_lie_in_one_slot():
    assert html_text.whole_rounds([(1, 0), (2, 1), (5, 0), (6, 1)], 2) == [[1, 2], [5, 6]]
    assert html_text.whole_rounds([(1, 0), (2, 0), (5, 1)], 2) == [[2, 5]]
    assert html_text.whole_rounds([(1, 1), (2, 0)], 2) == [] and html_text.whole_rounds([(1, 0)], 2) == []


def test_main_text_of_copies(spark):
    page = "<div class='h'>Head</div><div class='i'>Line</div><div class='b'><p>A long text that all copies of the page share.</p><p>{}</p></div>"
    rows = [(i, f"http://c.example/{i}", page.format(f"Visit {i}")) for i in range(6)]
    got = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all("A long text" in r.text and f"Visit {r.page_id}" in r.text for r in got)


def test_equal_ids_are_candidates_of_each_other(spark):
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.1]), (1, [5.0, 5.0]), (2, [1.0, 0.1])]
    got = nearest.nearest(nearest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(1, 2), (1, 2), (2, 100), (2, 100), (3, 1), (3, 1)]


def test_quality_rules_against_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(quality_rules.ORACLE_SQL)
    got = quality_rules.op5_quality_rules(spark, SF)
    assert docs.count() == got.count()
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_field_against_its_word_list(spark):
    """Marginals of the field judge held-out documents no worse than the list its tokens were labelled with."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    from heliograph.llm.labelled import training_sample

    taught = [([w for w in map(toxicity.normal, r.text.split()) if w], r.label) for r in training_sample(docs, labels, "toxic", 5, 0, 1000).collect()]
    bad = toxicity.offences(taught)
    listed = lambda t: any(f"w:{w}" in bad or any(f"p:{w[:k]}" in bad for k in toxicity.PREFIXES if len(w) > k) for w in map(toxicity.normal, (t or "").split()))
    rows = toxicity.tag_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum((r.score >= 0.5) == r.toxic for r in rows) >= sum(listed(r.text) == bool(r.toxic) for r in rows)


@pytest.mark.parametrize("rows", [[], ODD])
def test_pipeline_stages(spark, rows):
    """Every stage on its predecessor's rows: ids stay known, clean rows stay where a stage filters, columns are those of documents."""
    docs = spark.createDataFrame(rows, DOCS)
    extra = docs.withColumn("_n", F.lit("mine"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = mixing.cut(stage(spark, extra if k == 0 else docs, SF))
        if k < 4:
            assert out.columns == corpus_pipeline.COLUMNS
        before, after = (sorted(str(r.doc_id) for r in x.collect()) for x in (docs, out))
        assert set(after) <= set(before)
        if name in ("toxicity", "secrets", "pieces"):
            assert before == after
        if name == "near_duplicates":
            assert [r.doc_id for r in out.collect() if r.doc_id in (4, 6)] == ([4] if rows else [])
        docs = out
