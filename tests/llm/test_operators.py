"""The training-data operators on small inputs: brute force, round trips, held-out accuracy and odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.llm import html_text, mixing, near_duplicates as nd, nearest, quality_classifier, quality_rules, sampled_pieces, secret_scan, substring_dedup, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows."""
    rows = [(1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "", "xx", None, 0), (3, "  \n\t", "en", "s", 4), (4, " ".join(words(1, 3000)), "en", "t", 1), (4, " ".join(words(1, 3000)), "en", "t", 1), (5, "x" * 5000, None, "s", 5000)]
    return spark.createDataFrame(rows, DOCS)


def test_nearest_against_brute_force(spark):
    r = np.random.Generator(np.random.PCG64(1))
    v = r.standard_normal((400, 16)).astype("float32")
    v[7] = v[300] = v[301]
    rows = [(i, v[i].tolist()) for i in range(400)] + [(1000, None), (1001, [0.0] * 16), (1002, [None] + [1.0] * 15), (1003, [float("nan")] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for x in nearest.nearest(nearest.usable(df), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(x.query_id, {})[x.rank] = (x.vec_id, x.score)
    hit = 0
    for q in (0, 100, 200, 300):
        d = np.sqrt(((v.astype(float) - v[q].astype(float)) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(400), d)).tolist() if i != q][:10]
        assert sorted(got[q]) == list(range(1, 11))
        hit += len({i for i, _ in got[q].values()} & set(best))
    assert set(got) == {0, 100, 200, 300} and hit >= 38
    assert [got[300][1], got[300][2]] == [(7, 0.0), (301, 0.0)]


def test_nearest_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest.nearest(nearest.usable(df), F.col("vec_id") % 100 == 0).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_alignment_against_plain_distance():
    r = random.Random(3)
    for _ in range(60):
        a = [r.randint(1, 5) for _ in range(r.randint(0, 40))]
        b = [x for x in a if r.random() > 0.1] + [9] * r.randint(0, 3)
        want, most = distance(a, b), r.randint(0, 40)
        got = nd.edit_distances([(np.array(a, np.uint32), np.array(b, np.uint32))], [most])[0]
        assert got == min(want, most + 1)


def test_prints_never_rule_out_near_duplicates():
    r = np.random.Generator(np.random.PCG64(4))
    for n in (1, 4, 60, 900, 6000):
        a = r.integers(0, 40, n, dtype=np.uint32)
        for edits in (0, 1, n // 50, n // 6):
            at = r.integers(0, n, edits)
            b = np.delete(a, at[: edits // 2])
            b[r.integers(0, max(1, len(b)), edits // 2)] = 7
            words = np.concatenate([a, b])
            bits = nd.prints(words, np.repeat([0, 1], [len(a), len(b)]), 2)
            differ = sum(int(v).bit_count() for v in (bits[0] ^ bits[1]).view(np.uint64))
            if n < 1000:
                assert differ + abs(len(a) - len(b)) <= 2 * distance(a.tolist(), b.tolist())


def plain_classes(texts):
    """Least id of each text's class: connected by edit similarities of 0.8 or more, without the module."""
    ids, root = sorted(texts), {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = texts[i], texts[j]
            most = int(0.2 * max(len(a), len(b)) + 1e-9)
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(set(a) & set(b)) > 0.3 * len(set(a)) and distance(a, b) <= most:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_near_duplicates_against_brute_force(spark, odd):
    r, texts = random.Random(8), {}
    for k in range(24):
        w = words(100 + k, r.randint(60, 150))
        texts[10 * k + 100] = w
        if k % 2 == 0:
            texts[10 * k + 101] = list(w)  # a copy
            for j, rate in ((2, 0.03), (3, 0.07)):  # words changed, dropped, put in
                texts[10 * k + 100 + j] = [x for y in w for x in ([y] if r.random() > rate else r.choice([[], ["new"], [y, "more"]]))]
            texts[10 * k + 104] = w[60:] + w[:60] + words(k, 200)  # not near
            texts[10 * k + 105] = w[: len(w) // 2] + words(k + 50, len(w) // 2)  # half of it
    rows = [(i, " ".join(w), "en", "s", 1) for i, w in texts.items()]
    df = spark.createDataFrame(rows + rows[:3], DOCS).unionByName(odd)
    found = nd.near_duplicates(df.select("doc_id", "text")).collect()
    want = plain_classes(texts)
    for x in found:
        if x.doc_id and x.doc_id >= 100:
            assert x.class_id == want[x.doc_id]
    kept = [x for x in found if x.kept]
    assert sorted(x.doc_id for x in kept if x.doc_id and x.doc_id >= 100) == sorted(set(want.values()))  # one row a class, also of equal rows
    assert len(found) == df.count() and sum(x.doc_id == 4 for x in kept) == 1
    assert nd.keep_one(odd).count() == 6


def test_near_duplicates_on_given_documents(spark):
    """Recall against all pairs of sf0.01 with an edit similarity of 0.8 or more, by plain alignment."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").limit(400)
    rows, number = docs.collect(), {}
    texts = {tuple(number.setdefault(w, len(number)) for w in (r.text or "").split()): r.doc_id for r in rows}
    order = sorted((k for k in texts if len(k) >= 20), key=len)
    counts = {k: Counter(k) for k in order}
    classes = {r.doc_id: r.class_id for r in nd.near_duplicates(spark.createDataFrame(rows)).collect()}
    pairs = [
        (a, b) for n, a in enumerate(order) for b in order[n + 1 :]
        if len(a) >= 0.8 * len(b) and len(b) - sum((counts[a] & counts[b]).values()) <= 0.2 * len(b) and fast_distance(a, b) <= 0.2 * len(b)
    ]
    assert len(pairs) >= 5
    assert sum(classes[texts[a]] == classes[texts[b]] for a, b in pairs) >= 0.9 * len(pairs)


def fast_distance(a, b):
    b, row = np.array(b), np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        new = np.concatenate(([i], np.minimum(row[1:] + 1, row[:-1] + (b != x))))
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row[-1])


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_meets_targets(spark, odd, seed):
    r = random.Random(seed)
    rows = [(i, " ".join(["w"] * r.randint(0, 60)), "en", r.choice(["a", "b", "c", None]), 0) for i in range(600)]
    sizes = mixing.sized(spark.createDataFrame(rows, DOCS).unionByName(odd)).cache()
    targets = mixing.source_targets(sizes)
    t = {x.source: x for x in targets.collect()}
    total = sum(x.source_size for x in t.values())
    assert math.isclose(sum(x.target for x in t.values()), 1.5 * total, rel_tol=1e-9)
    out = mixing.mix(sizes, targets).collect()
    assert len(out) == sizes.count()
    for s, x in t.items():
        taken = sum(o.taken for o in out if o.source == s)
        largest = max(o.size for o in out if o.source == s)
        assert abs(taken - x.target) <= largest / 2 + 1 and x.target <= 2 * x.source_size + 1e-6
    assert all(o.size == 0 or o.taken % o.size == 0 and o.taken <= 2 * o.size for o in out)
    again = mixing.mix(sizes, targets).collect()
    key = lambda o: (o.doc_id or -1, o.source or "", o.size, o.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_skips_what_does_not_fit(spark):
    sizes = [2000] + [51 + i % 7 for i in range(60)] + [400, 300, 210]
    docs = spark.createDataFrame([(i, s, n) for s in ("a", "b", None) for i, n in enumerate(sizes)], "doc_id long, source string, size long")
    total = sum(sizes)
    for target in (total * 0.31, total * 0.5, total * 1.43):
        targets = docs.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("target", F.lit(float(target)))
        out = mixing.mix(docs, targets, seed=f"s{target}").groupBy("source").agg(F.sum("taken").alias("taken")).collect()
        assert len(out) == 3 and all(abs(r.taken - target) <= 1 for r in out), (target, out)


def test_repeated_passages(spark, odd):
    shared = words(5, 60)
    rows = [(k, " ".join(words(50 + k, 100 + k) + (shared if k < 3 else []) + words(90 + k, 80)), "en", "s", 0) for k in range(100, 110)]
    rows += [(k, " ".join(words(50 + k, 70 + k) + shared + words(200 + k, 40)), "en", "s", 0) for k in range(200, 203)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, DOCS).unionByName(odd)).collect()
    assert {r.doc_id for r in got if r.doc_id >= 100} == {200, 201, 202}
    assert all(r.first_doc_id == 200 and r.n_words <= 62 and r.dropped == (r.doc_id > 200) for r in got if r.doc_id >= 200)


def test_cuts_resist_insertions():
    a = " ".join(words(7, 400)).encode()
    b = a[:50] + b"inserted " + a[50:]
    x, y = (set(np.diff(substring_dedup.cuts(t)).tolist()) for t in (a, b))
    ends_a, ends_b = substring_dedup.cuts(a), substring_dedup.cuts(b)
    assert set((ends_a[ends_a > 400] + 9).tolist()) <= set(ends_b.tolist()) and x and y
    assert substring_dedup.cuts(b"").size == 0


def base_counts(text):
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    seen, covered = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(8)}
    lines = [x for x in (text or "").split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_against_python(spark, odd):
    rep = "a b c d e f g h i\n" * 4 + "x y z # $$ é"
    df = spark.createDataFrame([(50, rep, "en", "s", 0)], DOCS).unionByName(odd).unionByName(spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source", "n_chars"))
    texts = {}
    for r in df.collect():
        texts.setdefault(r.doc_id, r.text)
    for r in quality_rules.quality_rules(df.select("doc_id", "text", "lang")).collect():
        want = base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)


def test_classifiers_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    for f, label, least in ((quality_classifier.classify, "quality", 0.9), (toxicity.tag_toxicity, "toxic", 0.9)):
        out = f(docs, labels).join(labels, "doc_id").where("held_out")
        right = out.where(F.col("predicted") == F.col(label)).count()
        assert right >= least * out.count()


def test_classifiers_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_classifier.classify(odd, none).collect()} == {0.5}
    assert {r.score for r in toxicity.tag_toxicity(odd, none).collect()} == {0.5}


def test_forward_backward_against_enumeration():
    e, trans = np.array([0.3, -1.0, 2.0, 0.5, -0.2]), np.array([-0.5, -1.0, 0.4, 0.8])
    f, b = toxicity.forward_backward(e, np.array([True, False, False, True, False]), trans)
    t = {(0, 0): 0.0, (0, 1): trans[1], (1, 0): trans[2], (1, 1): trans[3]}
    for chain, offset in ((e[:3], 0), (e[3:], 3)):
        total, marginal = 0.0, np.zeros(len(chain))
        for m in range(1 << len(chain)):
            s = [(m >> i) & 1 for i in range(len(chain))]
            weight = math.exp(s[0] * trans[0] + sum(x * y for x, y in zip(s, chain)) + sum(t[p] for p in zip(s, s[1:])))
            total, marginal = total + weight, marginal + weight * np.array(s)
        odds = f[offset : offset + len(chain)] * b[offset : offset + len(chain)]
        assert np.allclose(odds / (1 + odds), marginal / total)


def test_pieces_round_trip(spark, odd):
    extra = spark.createDataFrame([(90, "a▁b  c\n\n😀一x \x00", "en", "s", 0)], DOCS)
    df = odd.unionByName(extra)
    out = sampled_pieces.encode_pieces(df, sampled_pieces.row_key(F.col("doc_id")))
    rows = sampled_pieces.decode_pieces(out).collect()
    assert all(r.decoded == r.text and (r.text is None) == (r.ids is None) for r in rows)
    same = {(r.doc_id, r.text): r.ids for r in out.repartition(3).collect()}
    assert all(same[r.doc_id, r.text] == r.ids for r in rows)


def test_piece_draws_follow_the_weights():
    s = sampled_pieces.Sampler()
    text = "the"
    flat, off = s.encode([text] * 4000, list(range(4000)))
    seen = {}
    for a, b in zip(off[:-1], off[1:]):
        seen[tuple(flat[a:b])] = seen.get(tuple(flat[a:b]), 0) + 1
    weight = {k: math.prod(float(s.v.node_weight[np.flatnonzero(s.v.node_piece == i)[0]]) for i in k) for k in seen}
    total = sum(weight.values())
    assert all(abs(n / 4000 - weight[k] / total) < 0.03 for k, n in seen.items()) and len(seen) > 1


def test_secret_labels_and_redaction(spark, odd):
    text = b'x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" mail und.42@mail8.example.com ip 42.144.35.254 build = "a81bc81bdead4e5dabff90865d1e13b1"'
    found = {core: secret_scan.context_label(c) for _, _, _, c, core in secret_scan.candidates(text)}
    assert found == {"04dbebab91ab85687d33eeaaf9ac699e1188f962": 1, "und.42@mail8.example.com": 0, "42.144.35.254": 0, "a81bc81bdead4e5dabff90865d1e13b1": 0}
    rows = [(100 + i, f'word token = "{random.Random(i).getrandbits(160):040x}" word und.{i:02d}@mail8.example.com', "en", "s", 0) for i in range(30)]
    # A secret's look is learnt: it is found without a name before it.
    rows.append((200, f"a commit {random.Random(77).getrandbits(160):040x} of und.77@mail8.example.com", "en", "s", 0))
    df = spark.createDataFrame(rows, DOCS).unionByName(odd)
    out = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert all('"[SECRET]"' in out[i] and "@mail8" in out[i] for i in range(100, 130)) and len(out) == 37
    assert "[SECRET]" in out[200] and "@mail8" in out[200]
    assert secret_scan.scan(odd).where("is_secret").count() <= 1  # one long run of x


def test_secret_forest_on_held_out_values(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labelled = secret_scan.cut(secret_scan.labelled_sample(docs, secret_scan._dictionary(docs)))
    forest = secret_scan.train_forest(labelled.where("pmod(key, 3) != 0").drop("key"))
    held = labelled.where("pmod(key, 3) = 0").toPandas()
    said = secret_scan.forest_scores(forest, held[secret_scan.FEATURES].to_numpy(float)) >= 0.5
    true = held["label"].to_numpy() == 1
    assert true.sum() > 0 and (said & true).sum() >= 0.9 * true.sum() and (said & true).sum() >= 0.9 * said.sum()


def test_every_run_of_a_word_is_a_candidate():
    h = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    forms = ['{"api_key":"%s"}', '(token="%s")', 'a|token="%s"', "https://h.example/path?token=%s", "https://h.example/path?a=b&token=%s&x=1", "S3_SECRET_KEY='%s'", "S3_SECRET_KEY=%s", "env:dbPassword=%s", "token\t:\n%s", '{"user":"bob","password": "%s","id":1}']
    for form in forms:
        for value in (h, "lettersonlyhere", "pw1"):
            text = ("some words " + form % value + " more").encode()
            found = {text[a:b].decode(): secret_scan.context_label(c) for a, b, _, c, _ in secret_scan.candidates(text)}
            assert value in found and not any("key" in x.lower() for x in found)
            if value == h and ("=" in form or '"' in form):
                assert found[h] == 1
    assert [c for *_, c in secret_scan.candidates(f'x,{h},y <td>{h}</td> {h}== note: plain'.encode())] == [h, h, h + "=="]


def test_main_text(spark):
    page = "<html><head><title>t</title></head><body><nav><a>menu</a></nav><div class='ad'>buy</div>{}<footer>f</footer>"
    art = "<article><h1>A &amp; B</h1><p>one\n two<p><b>three</b><script>var t='</p>'</script><aside>no</aside></article>"
    plain = "<div class='top'>Same on all</div><div id='content'><p>Body text number {0} runs here.</p><p>Second {0}.</p></div><div class='comments'>me too</div>"
    rows = [(1, "http://a.example/1", page.format(art)), (2, None, None), (3, "x", "")] + [(10 + i, f"http://b.example/{i}", page.format(plain.format(i))) for i in range(5)]
    got = {r.page_id: r for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "A & B\none two\nthree" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "" and got[3].text == ""
    assert all(got[10 + i].text == f"Body text number {i} runs here.\nSecond {i}." for i in range(5))


def test_main_text_of_every_layout(spark):
    page = "<html><body><div class='top'>Same on all</div>{}</body></html>"
    post = "<div class='post'><p>Post {0} begins.</p><ul><li>A long item of the list in post number {0}.</li></ul><p>Post {0} ends.</p></div>"
    wiki = "<div class='wiki'><p>Wiki {0}.</p></div><div class='more'><p>More of wiki {0}.</p></div>"
    rows = [(i, f"http://c.example/{i}", page.format(post.format(i))) for i in range(6)] + [(10 + i, f"http://c.example/w{i}", page.format(wiki.format(i))) for i in range(4)]
    rows += [(20 + i, None, f"<div class='long'><p>A page of no host, number {i}.</p></div>") for i in range(4)] + [(30, "x", "<div class='b'>Short.</div>")]
    rows += [(40 + i, f"http://d.example/{i}", "<div class='k'><p>One copy.</p></div>") for i in range(3)]
    got = {r.page_id: r.text for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Post {i} begins.\nA long item of the list in post number {i}.\nPost {i} ends." for i in range(6))
    assert all(got[10 + i] == f"Wiki {i}.\nMore of wiki {i}." for i in range(4))
    assert all(got[20 + i] == f"A page of no host, number {i}." for i in range(4)) and got[30] == "Short."
    assert {got[40 + i] for i in range(3)} == {"One copy."}


def test_main_text_by_classes_of_tokens(spark):
    page = "<html><body><p>Head line</p><article><p>Share this story</p><p>Own {0}.</p>{1}<p>Rated by readers</p></article><p>Foot line</p></body></html>"
    rows = [(i, f"http://e.example/{i}", page.format(i, "<p>On some pages</p>" if i % 3 else "")) for i in range(9)]
    lines = ["<p>First line</p>", "<p>Second line</p>", "<p>Third line</p>"]
    rows += [(20 + i, f"http://f.example/{i}", "".join([*lines, f"<p>Own {i}.</p>"] if i else [*lines[1:], f"<p>Own {i}.</p>", lines[0]])) for i in range(6)]
    got = {r.page_id: r.text for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # The lines of every page are one class, in articles too; a line alone in its class is none.
    assert all(got[i] == f"Own {i}." + ("\nOn some pages" if i % 3 else "") for i in range(9))
    assert all(got[20 + i] == f"Own {i}." for i in range(1, 6)) and got[20] == "Own 0.\nFirst line"
    assert html_text.in_order([0, 0, 5, 2, 3]) == [0, 1, 3, 4] and html_text.in_order([]) == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert quality_rules.quality_rules(none.select("doc_id", "text", "lang")).count() == 0
    assert nd.near_duplicates(none.select("doc_id", "text")).count() == 0
    assert substring_dedup.repeated_passages(none).count() == 0
    assert secret_scan.scan(none).count() == 0
