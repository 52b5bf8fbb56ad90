"""Near-dedup, decontamination, secrets, URLs and quality against brute force, and on awkward tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, near_dedup, quality, secrets, url_filter, words
from corpusloom.llm.graph import components

DOCS = "doc_id long, text string, job string, rep string, kinds string, region string, found string, hits string"


def table(spark, rows):
    """Documents with extra columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x") for i, t in rows], DOCS)


# ---- words ----


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0caAbBzé日 .", max_size=30)), max_size=12), st.integers(1, 60))
def test_words_of_any_column(texts, limit):
    found = {}
    for at, data, offsets in words.pieces(pa.array(texts, pa.string()), limit):
        rows, hashes, starts, ends = words.word_hashes(data, offsets)
        for r, h, s, e in zip(rows, hashes, starts, ends, strict=True):
            found.setdefault(at + int(r), []).append((bytes(data[s:e]).decode(), int(h)))
    known = {}
    for i, text in enumerate(texts):
        plain = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert [w for w, _ in found.get(i, [])] == plain
        for w, h in found.get(i, []):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            assert known.setdefault(low, h) == h
    assert len(set(known.values())) == len(known)


# ---- near-dedup ----


def sets_of(text, k):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k):
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    all_sets = [(i, sets_of(t, k)) for i, t in rows if i is not None]
    for n, (a, x) in enumerate(all_sets):
        for b, y in all_sets[:n]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(["foo", "bar", "baz"]) + str(rng.randrange(50))
    return " ".join(w)


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rng = random.Random(k)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(rng.randrange(20, 90))) for _ in range(12)]
    rows = [(i, edited(rng, rng.choice(base), rng.randrange(6))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one"), (1004, "One"), (1005, "one two"), (1006, "w " * 20_000)]
    rows += [(7, rows[7][1]), (None, base[0]), (None, None)]
    out = near_dedup.near_duplicates(table(spark, rows), k=k).collect()
    want = brute_components(rows, k)
    assert len(out) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)
            assert r.n_shingles == len(sets_of(texts[r.doc_id], k))


def test_large_cluster_goes_through_all_passes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(3)
    base = " ".join(f"w{rng.randrange(500)}" for _ in range(60))
    rows = [(i, edited(rng, base, rng.choice([0, 1, 1, 2, 4, 7]))) for i in range(120)]
    out = near_dedup.near_duplicates(table(spark, rows), k=2).collect()
    assert {r.doc_id: r.component_id for r in out} == brute_components(rows, 2)


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text), (1, text), (1, text), (2, text + " x"), (5, "other words stand here now"), (6, None), (None, text), (None, text)]
    kept = near_dedup.drop_near_duplicates(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 5), (False, 6), (True, 0), (True, 0)]
    assert near_dedup.drop_near_duplicates(table(spark, [])).count() == 0


def test_pairs_are_compared_in_a_crowd():
    # one region of unlinked sets; two near ones stand twenty places apart, also across a batch border
    rng = np.random.default_rng(8)
    bits = rng.integers(0, 256, (60, near_dedup.K), dtype=np.uint8)
    bits[40] = np.where(np.arange(near_dedup.K) < 105, bits[20], bits[40])
    columns = [pa.array(np.zeros(60, np.int64)), pa.array(np.arange(60)), pa.array([x.tobytes() for x in bits], pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, names=["region", "rep", "bits"])
    for cut in (60, 30, 1):
        batches = iter([batch.slice(at, cut) for at in range(0, 60, cut)])
        found = [tuple(r.values()) for b in near_dedup._meet(batches) for r in b.to_pylist()]
        assert set(found) == {(20, 40)}, cut


# ---- decontamination ----


def fit_brute(item, text):
    """Least edit distance of an item's words to any run of a text's words."""
    words_of = lambda t: re.findall(r"[^\W_]+", t.lower())
    a, b = words_of(item), words_of(text)
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(9)
    word = lambda: rng.choice("bcdfgh") + rng.choice("aeiou") + rng.choice("klmnp") + rng.choice("aeiou")
    items = [(i, " ".join(word() for _ in range(rng.choice([4, 6, 14, 30, 59])))) for i in range(12)]
    docs = []
    for i in range(60):
        text = [word() for _ in range(rng.randrange(0, 80))]
        item = rng.choice(items)[1]
        part = edited(rng, item, rng.randrange(0, max(1, len(item.split()) // 4 + 2))).split()
        if rng.random() < 0.7:
            at = rng.randrange(len(text) + 1)
            text[at:at] = part if rng.random() < 0.8 else part[: len(part) // 2]
        docs.append((i, (", " if i % 3 else "\n").join(text).upper() if i % 2 else " ".join(text)))
    docs += [(100, None), (101, ""), (102, items[3][1]), (None, items[3][1]), (102, items[3][1])]
    benchmark = spark.createDataFrame([*items, (50, None), (51, ""), (None, "a b c d e f g")], "item_id long, text string")
    out = decontaminate.contamination(table(spark, docs), benchmark).collect()
    want = []
    for i, text in docs:
        for j, item in items:
            n = len(item.split())
            least = fit_brute(item, text or "")
            if n >= decontaminate.MIN_WORDS and least <= decontaminate.allowed(n):
                want.append((i, j, least, n))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    found = sorted((tuple(r) for r in out), key=key)
    assert found == sorted(want, key=key) and len(want) > 20
    clean = decontaminate.drop_contaminated(table(spark, docs), benchmark)
    assert clean.columns == table(spark, docs).columns
    dirty = {(w[0]) for w in want}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in docs if i not in dirty)


def test_short_and_unspaced_items_are_found(spark):
    chinese, thai = "春江潮水连海平海上明月共潮生滟滟随波千万里何处春江无月明", "สวัสดีครับผมชื่อสมชายยินดีที่ได้รู้จัก"
    items = [(1, "Who wrote Hamlet?"), (2, chinese), (3, thai), (4, "Oslo"), (5, "これはペンです")]
    docs = [
        (1, "quiz: who wrote, hamlet and when"), (2, "who never wrote hamlet"), (3, "前文很长。" + chinese + "。后文"),
        (4, "前文，" + chinese[:9] + "山" + chinese[10:20] + chinese[21:] + "后"), (5, chinese[:12]), (6, "ดูนี่" + thai), (7, "in OSLO."), (8, "oslofjord"),
        (9, "彼は言った「これは、ペンです」と"), (10, None),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.edits, r.item_words) for r in decontaminate.contamination(table(spark, docs), benchmark).collect())
    assert found == [(1, 1, 0, 3), (3, 2, 0, 28), (4, 2, 2, 28), (6, 3, 0, len(thai)), (7, 4, 0, 1), (9, 5, 0, 7)]
    clean = decontaminate.drop_contaminated(table(spark, docs), benchmark)
    assert sorted(r.doc_id for r in clean.collect()) == [2, 5, 8, 10]


def test_empty_sides(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = table(spark, [(1, "some text")])
    assert decontaminate.contamination(docs, none).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == 1
    item = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontaminate.contamination(table(spark, []), item).count() == 0


# ---- secrets ----

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)


def brute_spans(text):
    out = []
    for number, (kind, pattern, group, least) in enumerate(
        [("assign", ASSIGN, 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24),
         ("github", re.compile("gh[pousr]_[A-Za-z0-9]+"), 0, 40), ("pem", re.compile("-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 1)]
    ):
        out += [(m.start(), number, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def test_secrets_equal_brute_force(spark):
    rng = random.Random(4)
    parts = ["PassWord=hunter22", "secret=token\"=abcdef", "api_key: 'abc'", "APIKEY=\"Zx9-_./=+1", "token:aaaaaa,token:bbbbbb", "AKIA" + "Q" * 16, "AKIAX",
             "AKIAAKIA" + "7" * 20, "0123456789abcdef01234567", "deadbeef", "f" * 60, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "é日本", "plain words", "\n"]
    rows = [(i, rng.choice([" ", "", "日"]).join(rng.choice(parts) for _ in range(rng.randrange(8)))) for i in range(200)]
    rows += [(500, None), (501, ""), (None, "token=abcdefg"), (3, "token=abcdefg"), (3, "nothing"), (502, "x" * 100_000 + " secret=abcdef")]
    out = secrets.secret_digest(table(spark, rows)).collect()
    want = sorted((-1 if i is None else i, brute_spans(t)) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.spans) for r in out) == want
    for r in out:
        kinds = [s.split(":")[0] for s in r.spans.split(",")] if r.spans else []
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
    assert secrets.secret_digest(table(spark, [])).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [[["aki", "kia"]]]
    assert secrets.trigram_query("[0-9a-f]+") == [] and secrets.trigram_query("ab?") == []
    assert secrets.trigram_query("(abc|de)f") == [] or secrets.trigram_query("(abc|de)f") == [[["abc", "bcf"], ["def"]]]
    assert [["api", "ike", "key", "pik"] in place for place in secrets.trigram_query(secrets.RULES[0].pattern)] == [True]


# ---- urls ----


def brute_url(url):
    url = url or ""
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    m = re.search(r"://([^/?#]*)([^?#]*)", url)
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name)) if fits else None
    hits = lambda terms: sum(bool(re.search(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", lower(url))) for t in terms)
    strict, soft = hits(url_filter.STRICT), hits(url_filter.SOFT)
    own = "block" if strict or soft >= 2 else "allow"
    return host, path, rule and rule.name, rule.verdict if rule else own, strict, soft


def test_urls_equal_brute_force(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x", "http://a.net", "http://a.net/", "http://xnet/", "https://example.com/de/1?q=free", "https://shop.org/fr/",
            "http://free-bets.biz/", "http://a.biz/free/free/free", "http://a.biz/free-win", "http://a.biz/freewin", "http://xxx.biz", "http://a.biz/?x=casino#y", "http://é.biz/bet_win", "x://y://z/net/"]
    rows = [(i, u, "h", "h") for i, u in enumerate([*urls, urls[4]])] + [(None, urls[5], "h", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, hits string")
    out = url_filter.judge(pages).collect()
    found = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict, r.n_strict, r.n_soft) for r in out)
    want = []
    for i, u, *_ in rows:
        host, path, rule, verdict, strict, soft = brute_url(u)
        want.append((str(i), host, path, str(rule), verdict, strict, soft))
    assert found == sorted(want)
    assert url_filter.judge(pages.limit(0)).count() == 0


# ---- quality ----


def graded_corpus(n, seed):
    rng = random.Random(seed)
    rows, grades = [], []
    for i in range(n):
        text = " ".join(rng.choice("bdfgklmn") + rng.choice("aeiou") + rng.choice("rst") for _ in range(60))
        grade = rng.choice([0, 1, 2, 2])
        if grade == 0:
            text = text.upper() + "!!"
        if grade == 1:
            text += " idiot scum trash"
        rows.append((i, text))
        grades.append((i, grade))
    return rows, grades


def test_ordinal_model_on_held_out_texts(spark):
    rows, grades = graded_corpus(600, 1)
    ratings = spark.createDataFrame([*grades[:400], (None, 2), (5, None)], "doc_id long, grade int")
    model = quality.fit_ordinal(table(spark, rows), ratings)
    assert (np.diff(model.thresholds) >= 0).all() and len(model.thresholds) == 2
    out = {r.doc_id: r for r in quality.grades(table(spark, rows), model).collect()}
    right = [abs(out[i].expected_grade - g) < 0.5 for i, g in grades[400:]]
    assert np.mean(right) > 0.95
    assert all(0 <= r.p_best <= 1 and r.p_best <= r.expected_grade <= 2 for r in out.values())
    kept = {r.doc_id for r in quality.keep_best(table(spark, rows), model).collect()}
    assert np.mean([(i in kept) == (g == 2) for i, g in grades[400:]]) > 0.95


def test_quality_of_awkward_tables(spark):
    odd = table(spark, [(1, None), (1, ""), (None, "a"), (2, "ab"), (2, "ab"), (3, "x " * 50_000)])
    nothing = spark.createDataFrame([], "doc_id long, grade int")
    model = quality.fit_ordinal(odd, nothing)
    assert quality.keep_best(odd, model).count() == 6 and quality.keep_best(odd, model).columns == odd.columns
    rows, grades = graded_corpus(200, 2)
    model = quality.fit_ordinal(table(spark, rows), spark.createDataFrame(grades, "doc_id long, grade int"))
    out = quality.grades(odd, model).collect()
    assert len(out) == 6 and len({r.p_best for r in out if r.doc_id == 1}) == 1
    assert quality.grades(table(spark, []), model).count() == 0


def test_rare_toxic_words_of_small_languages_count(spark):
    rng = random.Random(6)
    rows, grades = [], []
    for i in range(2000):
        lang = rng.choice(["en"] * 6 + ["de", "es"])
        stems = {"en": "bdfg", "de": "klmn", "es": "rstv"}[lang]
        text = [rng.choice(stems) + rng.choice("aeiou") + rng.choice("xyz") for _ in range(60)]
        toxic = rng.random() < 0.2
        if toxic:
            text[rng.randrange(60)] = {"en": "scum", "de": "dreck", "es": "basura"}[lang]
        rows.append((i, " ".join(text)))
        grades.append((i, lang, 1 if toxic else rng.choice([0, 2, 2, 2])))
        if grades[-1][2] == 0:
            rows[-1] = (i, rows[-1][1].upper() + "!!")
    fit_on = spark.createDataFrame([(i, g) for i, _, g in grades[:1400]], "doc_id long, grade int")
    kept = {r.doc_id for r in quality.keep_best(table(spark, rows), quality.fit_ordinal(table(spark, rows), fit_on), 0.5).collect()}
    for lang in ("en", "de", "es"):
        toxic = [i in kept for i, x, g in grades[1400:] if x == lang and g == 1]
        good = [i in kept for i, x, g in grades[1400:] if x == lang and g == 2]
        assert len(toxic) >= 5 and np.mean(toxic) < 0.2 and np.mean(good) > 0.8, lang


def test_repeated_ids_give_one_rated_row(spark, monkeypatch):
    rows, grades = graded_corpus(200, 3)
    seen = []
    fit = quality._fit
    monkeypatch.setattr(quality, "_fit", lambda found, kept, grades: seen.append(found.num_rows) or fit(found, kept, grades))
    again = rows + [(7, rows[7][1]), (8, None)] + [(9, "zzz")] * 300
    ratings = spark.createDataFrame(grades, "doc_id long, grade int")
    once, many = (quality.fit_ordinal(table(spark, r), ratings) for r in (rows, again))
    assert seen == [200, 200]
    assert np.array_equal(once.ids, many.ids) and np.allclose(once.weights, many.weights, atol=1e-6)


def test_quality_rejects_toxic_documents_of_every_language(spark):
    """Fitted on one half of the rated documents, held against the other half, from the smallest corpus up."""
    for folder, kept_good, kept_toxic in (("/root/testdata/sf0.001", 0.9, 0.5), ("/root/testdata/sf0.1", 0.97, 0.2)):
        docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
        half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0
        model = quality.fit_ordinal(docs, quality.graded_labels(labels.where(half)))
        held = docs.join(quality.graded_labels(labels.where(~half)), "doc_id")
        best = quality.grades(held, model).select("doc_id", (F.col("p_best") >= quality.KEEP_AT).alias("kept"))
        rows = held.select("doc_id", "lang", "grade").join(best, "doc_id").groupBy("grade", "lang").agg(F.count("*").alias("n"), F.avg(F.col("kept").cast("int")).alias("share")).collect()
        good = [r for r in rows if r.grade == 2]
        assert sum(r.n * r.share for r in good) / sum(r.n for r in good) >= kept_good
        toxic = [r for r in rows if r.grade == 0 and r.n >= 25]
        assert all(r.share <= kept_toxic for r in toxic), toxic


def test_near_dedup_of_a_row_repeated_very_often(spark):
    """A hub of equal rows beside a near copy: one row of it is compared, and all come back."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(9, text + " x"), (3, "other words"), (None, text)], "doc_id long, text string"))
    found = near_dedup.near_duplicates(rows, k=2).groupBy("doc_id", "component_id", "kept").count().collect()
    assert sorted(map(tuple, found), key=str) == sorted([(7, 7, True, 20_000), (9, 7, False, 1), (3, 3, True, 1), (None, None, True, 1)], key=str)


def test_components_of_hubs(spark):
    edges = [(0, i) for i in range(1, 3_000)] + [(i, i + 5_000) for i in range(1, 500)] + [(20_000, 20_001), (20_001, 20_000), (4, 4), (None, 1)]
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()
    nodes = {n for e in edges if None not in e and e[0] != e[1] for n in e}
    assert {r.node: r.root for r in found} == {n: 20_000 if n >= 20_000 else 0 for n in nodes} and len(found) == len(nodes)


def test_weighted_url_terms_from_a_table(spark):
    schema = "term string, strict boolean, weight double"
    rows = [("Bad", True, None), ("bad", False, 9.0), ("meh", False, 0.75), ("so", False, None), ("so", False, 0.5), ("", True, 1.0), (None, True, 1.0), ("x-y", None, 1.25)]
    terms = url_filter.terms_from_table(spark.createDataFrame(rows, schema))
    assert terms == (url_filter.Term("bad", True, 1.0), url_filter.Term("meh", False, 0.75), url_filter.Term("so", False, 1.0), url_filter.Term("x-y", False, 1.25))
    urls = ["http://a.com/bad", "http://a.com/badly/meh", "http://a.com/meh/so", "http://a.com/meh/meh/x-y", "http://a.com/meh?so&x-y", None, ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: (r.verdict, r.n_strict, r.n_soft) for r in url_filter.judge(pages, rules=(), terms=terms).collect()}
    assert found == {0: ("block", 1, 0), 1: ("allow", 0, 1), 2: ("allow", 0, 2), 3: ("block", 0, 2), 4: ("block", 0, 3), 5: ("allow", 0, 0), 6: ("allow", 0, 0)}
    assert url_filter.judge(pages, terms=()).where("verdict = 'block'").count() == 0


def test_long_items_are_confirmed_in_bounded_pieces(spark, monkeypatch):
    rng = random.Random(11)
    item = [f"w{rng.randrange(400)}" for _ in range(300)]
    near = [w if rng.random() > 0.1 else "other" for w in item]
    docs = [(1, " ".join(["a"] * 40 + near + ["b"] * 9)), (2, " ".join(item[:150] + ["z"] * 150)), (3, " ".join(item))]
    benchmark = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    wide = sorted(map(tuple, decontaminate.contamination(table(spark, docs), benchmark).collect()))
    monkeypatch.setattr(decontaminate, "WINDOW_WORDS", 1_000)
    assert sorted(map(tuple, decontaminate.contamination(table(spark, docs), benchmark).collect())) == wide
    assert [r[0] for r in wide] == [1, 3]


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    for nodes, count in ((300, 200), (120, 900), (40, 30)):
        edges = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(count)] + [(1_000 + i, 1_001 + i) for i in range(60)]
        root = {n: n for e in edges for n in e if e[0] != e[1]}
        changed = True
        while changed:
            changed = False
            for x, y in edges:
                if x != y and root[x] != root[y]:
                    root[x] = root[y] = min(root[x], root[y])
                    changed = True
        found = components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
        assert {r.node: r.root for r in found} == root and len(found) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
