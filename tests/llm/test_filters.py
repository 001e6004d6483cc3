"""URL reputation, quality classifier, template extraction."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadmill.llm import queries, template_html, url_reputation, weak_quality

# ---------------------------------------------------------------- urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [k for k, c in enumerate(rest) if c in "/?#"]
    host, rest = (rest[: ends[0]], rest[ends[0] :]) if ends else (rest, "")
    cut = min((k for k, c in enumerate(rest) if c in "?#"), default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:cut]


URLS = [None, "", "no scheme/x", "http://", "HTTP://WWW.Example.COM/en/1", "https://example.com/en", "http://example.com?x=/y", "http://a.net/es/#f", "http://net/fr/x?y", "x://É.Org/Path", "http://a.b.co.uk/q://z", "http://www.example.com/en/2#x", "http://notexample.com/en/", "a://b\nc/d\ne?f"]


def test_url_parts_and_rules(spark):
    df = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    host, path = url_reputation.url_parts(F.col("url"))
    rule, verdict = url_reputation.match_rules(F.col("host"), F.col("path"), queries.RULES)
    got = {r.page_id: r for r in df.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": rule, "verdict": verdict}).collect()}
    for k, u in enumerate(URLS):
        h, p = parts(u)
        fits = [r for r in queries.RULES if (h == r.text.split("/")[0] or h.endswith("." + r.text.split("/")[0])) and p.startswith(r.text[r.text.index("/") :])]
        best = max(fits, key=lambda r: len(r.text), default=None)
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (h, p, best and best.text, best and best.verdict), u


@pytest.mark.parametrize("host,domain,end", [("a.b.example.com", "example.com", "com"), ("x.co.uk", "x.co.uk", "co.uk"), ("y.x.co.uk", "x.co.uk", "co.uk"), ("com", "com", "com"), ("", "", ""), ("b.xco.uk", "xco.uk", "uk")])
def test_registered_domains(spark, host, domain, end):
    row = spark.createDataFrame([(host,)], "h string").select(url_reputation.registered_domain(F.col("h")), url_reputation.suffix(F.col("h"))).first()
    assert tuple(row) == (domain, end)


def test_reputation_shrinks_towards_the_domain_and_blocks_what_is_surely_bad(spark):
    rows = [("good.a.com", 1)] * 200 + [("bad.b.com", 0)] * 200 + [("bad.b.com", 1)] * 4 + [("new.b.com", 0)] + [("new.a.com", 0)] + [("none.org", None)] + [(f"h{k}.c.net", k % 2) for k in range(40)]
    found = {r.host: r for r in url_reputation.host_reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert found["good.a.com"].mean > 0.95 and found["good.a.com"].bad < 1e-9 and found["bad.b.com"].bad > 0.999999
    assert found["new.b.com"].mean < found["new.a.com"].mean
    assert found["none.org"].n == 0 and 0.05 < found["none.org"].bad < 0.95
    pages = spark.createDataFrame([(1, "http://bad.b.com/x", 5), (2, "http://good.a.com/x", 5), (3, "http://unseen.org/", 5), (None, None, 5), (1, "http://bad.b.com/x", 5)], "page_id long, url string, host int")
    got = sorted((r.page_id or 0, r.verdict) for r in url_reputation.judge_urls(pages, spark.createDataFrame(rows, "host string, good int"), []).collect())
    assert got == [(0, "allow"), (1, "block"), (1, "block"), (2, "allow"), (3, "allow")]


@pytest.mark.parametrize("a,b", [(0.3, 0.4), (1, 1), (2.5, 7), (40, 3), (0.3, 5), (300, 320), (1, 5000), (8000, 8100)])
def test_beta_distribution_equals_numeric_integration(a, b):
    # theta = s**4 takes the pole at 0 away, and 1 - s**4 the one at 1
    def mass(p, q, upto):
        s = (np.arange(400_000) + 0.5) / 400_000 * upto**0.25
        t = s**4
        logs = math.lgamma(p + q) - math.lgamma(p) - math.lgamma(q) + (p - 1) * np.log(t) + (q - 1) * np.log1p(-t) + np.log(4 * s**3)
        return float(np.exp(logs).sum() * upto**0.25 / 400_000)

    for x in (0.2, 0.5, 0.7):
        found = url_reputation.beta_below(x, np.array([a]), np.array([b]))[0]
        expected = mass(a, b, x) if x <= 0.5 else 1 - mass(b, a, 1 - x)
        assert abs(found - expected) < 1e-5


def test_a_hot_host_does_not_save_bad_ones(spark):
    rows = [(f"h{k}.x{k}.com", int(j < 17)) for k in range(57) for j in range(20)] + [(f"b{k}.y{k}.com", 0) for k in range(3) for _ in range(20)]
    hot = rows + [("hot.z.com", int(j < 510)) for j in range(600)]
    for labels in (rows, hot):
        found = {r.host: r.bad for r in url_reputation.host_reputation(spark.createDataFrame(labels, "host string, good int")).collect()}
        assert all(found[f"b{k}.y{k}.com"] > 0.95 for k in range(3)) and all(found[f"h{k}.x{k}.com"] < 0.01 for k in range(57))


def test_the_query_blocks_hosts_of_bad_pages_as_its_sql_does(spark, tmp_path):
    import duckdb

    rng = random.Random(5)
    pages, labels = [], []
    for k in range(900):
        host = rng.choice([f"h{rng.randrange(30)}.site{rng.randrange(8)}.{rng.choice(['org', 'net', 'co.uk', 'com'])}"] + ["hot.big.org"])
        bad = host.split(".")[1] in ("site3", "site5")
        pages.append((k, f"http://{host}/a/{k}"))
        if k % 3:
            labels.append((k, int(rng.random() < (0.02 if bad else 0.95))))
    spark.createDataFrame([*pages, (None, None)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([*labels, (None, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op1_host_reputation(spark, str(tmp_path))
    rows = [tuple(r) for r in got.collect()]
    db = duckdb.connect()
    for name in ("pages", "labels"):
        db.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    found = db.execute(queries.oracle_sql()["op1_host_reputation"])
    assert [d[0] for d in found.description] == got.columns
    assert sorted(rows, key=repr) == sorted(found.fetchall(), key=repr)
    judged = [(r[1], r[4]) for r in rows if r[3] is None]
    bad = [v for h, v in judged if h and h.split(".")[1] in ("site3", "site5")]
    assert bad.count("block") > 0.9 * len(bad) > 50
    assert all(v == "allow" for h, v in judged if not h or h.split(".")[1] not in ("site3", "site5"))


def test_reputation_without_pages_or_labels(spark):
    pages, outcomes = spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "host string, good int")
    assert url_reputation.judge_urls(pages, outcomes, queries.RULES).count() == 0
    some = spark.createDataFrame([(1, "http://a.de/")], "page_id long, url string")
    assert url_reputation.judge_urls(some, outcomes, queries.RULES).first().verdict == "allow"


# ---------------------------------------------------------------- quality


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    codes = np.zeros(len(truth), np.int64)
    accuracy = [0.95, 0.9, 0.85, 0.8, 0.9, 0.75, 0.95, 0.9, 0.85]
    for i, a in enumerate(accuracy):
        says = np.where(rng.random(len(truth)) < a, truth, ~truth)
        codes += np.where(rng.random(len(truth)) < 0.3, 0, np.where(says, weak_quality.GOOD, weak_quality.BAD)) * 3**i
    patterns, counts = np.unique(codes, return_counts=True)
    model = weak_quality.LabelModel.fit(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.02
    assert max(abs(x - a) for x, a in zip(model.accuracies().values(), accuracy, strict=True)) < 0.03
    assert ((model.posterior(codes) > 0.5) == truth).mean() > 0.97


def em_brute(codes):
    """Expectation-maximisation by loops over documents, from the definition."""
    votes = [[c // 3**i % 3 for i in range(9)] for c in codes]
    q = [0.95 if v.count(weak_quality.GOOD) > 2 * v.count(weak_quality.BAD) else 0.05 for v in votes]
    for _ in range(200):
        says = {}  # of those who vote, the share that votes good, by labeller and class
        for i in range(9):
            for c in (0, 1):
                good, bad = (0.5 + sum((x if c else 1 - x) for x, v in zip(q, votes, strict=True) if v[i] == kind) for kind in (weak_quality.GOOD, weak_quality.BAD))
                says[i, c] = good / (good + bad)
        prior = (sum(q) + 1) / (len(q) + 2)
        before, q = q, []
        for v in votes:
            a, b = prior, 1 - prior
            for i, x in enumerate(v):
                if x != weak_quality.NONE:
                    a *= says[i, 1] if x == weak_quality.GOOD else 1 - says[i, 1]
                    b *= says[i, 0] if x == weak_quality.GOOD else 1 - says[i, 0]
            q.append(a / (a + b))
        if max(abs(x - y) for x, y in zip(q, before, strict=True)) < 1e-9:
            break
    return q


def test_the_fit_equals_loops_over_documents(spark):
    """Patterns, posteriors and the scorer's optimum against plain versions, on documents of both kinds."""
    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choice("the of and a house river stone walks slowly under light".split()) for _ in range(n)) + "."
    junk = lambda n: " ".join(rng.choice([f"XQ{rng.randrange(99)}!!", "ZZ ##", "| |", "the", prose(3)]) for _ in range(n))
    rows = [(k, prose(rng.randrange(5, 90)) if k % 3 else junk(rng.randrange(5, 90))) for k in range(150)] + [(5, prose(30))] * 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = weak_quality.fit(docs.unionByName(docs.limit(0)))
    codes = [weak_quality.pattern(t) for _, t in rows]
    expected = em_brute(codes)
    assert np.allclose(model.labels.posterior(np.array(codes)), expected, atol=1e-6)
    got = {(r.pattern, round(r.weak_posterior, 6)) for r in weak_quality.classify(docs, model).collect()}
    assert got == {(c, round(e, 6)) for c, e in zip(codes, expected, strict=True)}
    # the loss that is stated: logistic on soft labels, both classes of equal weight, with a penalty; plain steps find its least
    x = np.array([weak_quality.features(t.split()) for _, t in rows])
    q = np.array(expected)
    scale = np.minimum(np.where(q >= 0.5, 0.5 / q.mean(), 0.5 / (1 - q.mean())), 10)

    def loss(w, b):
        z = x @ w + b
        return float((scale * (np.logaddexp(0, z) - q * z)).mean() + 0.5e-4 * w @ w)

    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(6000):
        g = (1 / (1 + np.exp(-(x @ w + b))) - q) * scale / len(q)
        w, b = w - 2.0 * (x.T @ g + 1e-4 * w), b - 2.0 * g.sum()
    assert loss(model.scorer.weights, model.scorer.bias) < loss(w, b) * 1.05 + 1e-3
    kept = {k for k, (_, t) in enumerate(rows) if model.scorer.score(t.split()) >= 0.5}
    plain = {k for k in range(len(rows)) if x[k] @ w + b >= 0}
    assert len(kept ^ plain) <= 2


def test_repeated_rows_do_not_swell_the_sample(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("1L as doc_id", "'the same text of a few words' as text").unionByName(spark.range(100).selectExpr("id + 10 as doc_id", "concat('the number ', id, ' of them all') as text"))
    seen = []
    real = weak_quality.Scorer.fit.__func__
    monkeypatch.setattr(weak_quality.Scorer, "fit", classmethod(lambda cls, x, q: seen.append(len(x)) or real(cls, x, q)))
    weak_quality.fit(docs, sample=10_000)
    assert seen == [101]


def test_held_out_accuracy(spark):
    """Labels are used here alone: the model has not seen them."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    found = weak_quality.classify(docs, weak_quality.fit(docs)).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    right = sum(r.keep == (r.quality == 1) for r in found)
    assert right / len(found) > 0.97
    good = [r.keep for r in found if r.quality == 1]
    assert sum(good) / len(good) > 0.99


def test_scores_equal_a_plain_loop_and_edge_cases_are_rejected(spark):
    rng = random.Random(1)
    prose = lambda: " ".join(rng.choice("the of and a house river stone walks slowly under light".split()) for _ in range(60)) + "."
    junk = lambda: " ".join(f"{rng.choice(['XQ', 'ZZ', 'QK'])}{rng.randrange(99)}!!" for _ in range(60))
    rows = [(k, prose() if k % 4 else junk(), "e") for k in range(120)] + [(200, None, "e"), (201, "", "e"), (202, " \n ", "e"), (None, prose(), "e"), (3, prose(), "e"), (203, prose() * 2000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = weak_quality.fit(docs)
    got = weak_quality.classify(docs, model).collect()
    assert len(got) == len(rows)
    expected = sorted((i if i is not None else -1, round(model.scorer.score((t or "").split()), 9)) for i, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, round(r.score, 9)) for r in got) == expected
    keep = {r.doc_id: r.keep for r in got}
    assert not keep[200] and not keep[201] and not keep[202] and keep[203]
    assert [k for k in range(120) if keep[k] != (k % 4 != 0)] == []
    kept = weak_quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)
    again = weak_quality.fit(docs.repartition(7))
    assert np.allclose(again.scorer.weights, model.scorer.weights)


def test_quality_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = weak_quality.fit(docs)
    assert model is None and weak_quality.classify(docs, model).count() == 0 and weak_quality.keep_good(docs, model).count() == 0


# ---------------------------------------------------------------- html


def page(body, site="http://a.com/1"):
    return (site, f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>")


ARTICLE = "<header class='site-header'><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><div id='cookie-notice'>We use cookies</div><main><article><h1>Title {k}</h1><p>First &amp; {k}<br>line</p><ul><li>one</li><li>two <b>bold</b></li></ul><aside>Related</aside><div class='ad-box'>Buy</div><form><input value='x'><p>Mail</p></form><p>Last &lt;{k}&gt; &eacute;</p><section class='comments'><p>Nice!</p></section></article></main><footer>&copy; me</footer>"


def texts(spark, rows, **options):
    df = spark.createDataFrame([(k, u, h, "e") for k, (u, h) in enumerate(rows)], "page_id long, url string, html string, text string")
    return {r.page_id: r.text for r in template_html.main_text(df, **options).collect()}


def test_articles_without_what_surrounds_them(spark):
    got = texts(spark, [page(ARTICLE.format(k=k)) for k in range(6)])
    assert got == {k: f"Title {k}\nFirst & {k} line\none\ntwo bold\nLast <{k}> é" for k in range(6)}


def test_pages_without_article_use_the_root_of_the_template(spark):
    body = "<div class='top'><a href='/'>Home</a> <a href='/b'>More</a></div><div class='content'><h2>Head {k}</h2><p>Text of page {k} with many words in it, more than links have.</p><p>More text {k} here, which differs on each page of them.</p></div><div class='right sidebar'><p>Side</p></div><p class='legalese'>Same on all pages</p>"
    got = texts(spark, [page(body.format(k=k)) for k in range(8)])
    assert got[3] == "Head 3\nText of page 3 with many words in it, more than links have.\nMore text 3 here, which differs on each page of them."


def test_text_that_all_articles_share_stays(spark):
    got = texts(spark, [page(f"<article><p>Shared line</p><p>Own {k}</p></article>") for k in range(9)])
    assert set(got.values()) == {f"Shared line\nOwn {k}" for k in range(9)}


def test_edge_cases(spark):
    rows = [page("<article><p>ok</p></article>")] * 4 + [("http://a.com/2", None), (None, ""), ("bad", "plain text"), page("<p>" + "x " * 50_000 + "</p>", "http://b.org/"), page("<article><p>un<b>closed<p>two<div>three", "http://c.org/"), page("a < b &amp; c <i>d</i>", "http://d.org/"), page("<article><p></p></article>", "http://e.org/")]
    got = texts(spark, rows)
    assert got[0] == got[3] == "ok"
    assert got[4] == got[5] == got[10] == ""
    assert got[6] == "plain text"
    assert len(got[7]) == 99_999
    assert got[8] == "unclosed\ntwo\nthree"
    assert got[9] == "a < b & c d"
    assert template_html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def tokens(*rows):
    """Tokens of (path, pages, vector)."""
    return {path: template_html.Token(pages, pages, vector, vector) for path, pages, vector in rows}


def test_classes_nest():
    where = template_html.classes_of(tokens(("html", 5, 1), ("html/body", 5, 1), ("html/body/ul", 5, 1), ("html/body/ul/li", 5, 2), ("html/body/ul/li/a", 5, 2), ("html/body/p", 4, 3)))
    assert where["html"] == where["html/body/ul"] != where["html/body/ul/li"] == where["html/body/ul/li/a"]
    assert len(set(where.values())) == 3
    # li and b share a vector but lie in two classes: an invalid class; b inside li has the vector of all by chance
    assert set(template_html.classes_of(tokens(("a", 9, 1), ("a/ul", 9, 1), ("a/ul/li", 9, 4), ("a/ul/li/b", 9, 1)))) == {"a", "a/ul", "a/ul/li"}
    assert set(template_html.classes_of(tokens(("a", 9, 1), ("a/ul", 9, 2), ("a/ul/li", 9, 4), ("a/dl", 9, 3), ("a/dl/b", 9, 4)))) == {"a", "a/ul", "a/dl"}


def plain_vectors(sources):
    """Occurrence vectors as tuples of counts, by another parser, of pages whose elements are all closed."""
    from collections import Counter
    from html.parser import HTMLParser

    counts = []
    for source in sources:
        stack, found = [], Counter()

        class Reader(HTMLParser):
            def handle_starttag(self, tag, attrs):
                names = sorted(n.lower() if k != "id" else "#" + n.lower() for k, v in attrs if k in ("class", "id") for n in v.split())
                stack.append(".".join([tag, *names]))
                found["/".join(stack)] += 1

            def handle_endtag(self, tag):
                assert stack.pop().split(".")[0] == tag

        Reader().feed(source)
        counts.append(found)
    return {p: tuple(c[p] for c in counts) for p in set().union(*counts)}


def neutral_site(rng, n, placed=False):
    """(pages, texts): pages whose elements have names without meaning, or none; the text is that of the content's slot."""
    names = [f"class='q{rng.randrange(10**2)}{k}'" for k in "abcde"] if not placed else [""] * 5
    say = lambda k: " ".join(rng.choice("stone river house lamp winter cloud road green seven later".split()) for _ in range(k))
    pages, texts = [], []
    for _ in range(n):
        menu = "".join(f"<span>{say(1)}</span> " for _ in range(rng.randrange(1, 6)))
        blocks = [say(rng.randrange(2, 5)), *(say(rng.randrange(25, 50)) for _ in range(rng.randrange(2, 6)))]
        body = f"<div {names[0]}>{menu}</div><div {names[1]}><h2>{blocks[0]}</h2>{''.join(f'<p>{b}</p>' for b in blocks[1:])}</div><div {names[2]}>{say(3)}</div><div {names[3]}><b>Imprint</b> {say(2)}</div>"
        pages.append(f"<html><body>{body}</body></html>")
        texts.append("\n".join(blocks))
    return pages, texts


@pytest.mark.parametrize("seed", range(3))
def test_classes_equal_those_of_plain_vectors(seed):
    import pyarrow as pa

    rng = random.Random(seed)
    pages, _ = neutral_site(rng, 12)
    pages = [p.replace("<b>", "<b><i></i>") if k % 3 else p for k, p in enumerate(pages)] + pages[:2]
    batch = pa.RecordBatch.from_arrays([pa.array(["h"] * len(pages)), pa.array(range(len(pages))), pa.array(pages)], names=["host", "tie", "html"])
    rows = [r for b in template_html._vectors(iter([batch])) for r in b.to_pandas().itertuples() if r.path]
    found, _ = template_html.differentiated(rows)
    vectors = plain_vectors(pages)
    assert set(found) == set(vectors)
    for p in found:
        assert {q for q in found if found[q].vector == found[p].vector} == {q for q in vectors if vectors[q] == vectors[p]}


@pytest.mark.parametrize("placed", [False, True])
def test_names_without_meaning(spark, placed, monkeypatch):
    """No article, no main, and no name that says anything; or no names at all: the vectors alone tell slots apart."""
    pages, expected = neutral_site(random.Random(4), 30, placed)
    rows = [("http://n.org/", p) for p in pages]
    assert texts(spark, rows) == dict(enumerate(expected))
    if placed:  # without equal vectors nothing is told apart
        monkeypatch.setattr(template_html, "page_numbers", lambda i: (i % 8191, i % 8191))
        monkeypatch.setattr(template_html.Token, "vector", property(lambda t: id(t)))
        df = template_html.pd.DataFrame([r for r in plain_rows(pages)])
        assert template_html.deduce(df).root != "html/body/div~2"
        assert template_html.deduce(df).split == set()


def plain_rows(pages):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["h"] * len(pages)), pa.array(range(len(pages))), pa.array(pages)], names=["host", "tie", "html"])
    return [r for b in template_html._vectors(iter([batch])) for r in b.to_pylist()]


def test_the_template_rests_on_valid_classes(monkeypatch):
    """Two notes of fixed text that share their vector by chance, each in another class, are no part of the template, so
    their text stays; with a constant in place of the classes it goes."""
    say = "the long story of page {k} with many words, more of them than anywhere else on the page"
    notes = lambda k: "".join(f"<div class='{o}'>" + (f"<div class='{i}'>note</div>" if k % 6 == 0 else f"{o}{k}") + "</div>" for o, i, n in (("u", "e", 2), ("v", "w", 3)) if k % n == 0)
    pages = [f"<html><body><div class='x'>m{k}</div><div class='z'><p>{say.format(k=k)}</p><p>{say.format(k=k)}</p>{notes(k)}</div></body></html>" for k in range(8)]
    df = template_html.pd.DataFrame(plain_rows(pages))
    monkeypatch.setattr(template_html, "FIXED_SHARE", 0.2)
    template = template_html.deduce(df, least_pages=2)
    assert template.root == "html/body/div.z" and not template.dropped
    assert template_html.extract(template_html.Page(pages[6]), template, template) == "\n".join([say.format(k=6), say.format(k=6), "note", "note"])
    monkeypatch.setattr(template_html, "classes_of", lambda found: dict.fromkeys(found, 0))
    constant = template_html.deduce(df, least_pages=2)
    assert constant.dropped == {"html/body/div.z/div.u/div.e", "html/body/div.z/div.v/div.w"}


def test_repeated_pages_and_copies_lose_nothing(spark):
    body = "<div class='m1'>menu</div><div class='m2'><h2>Head</h2><p class='lead'>The only text that this site has, on each of its pages, is this one.</p></div>"
    got = texts(spark, [page(body)] * 7)
    assert set(got.values()) == {"Head\nThe only text that this site has, on each of its pages, is this one."}


def test_small_hosts_lean_on_all_pages(spark):
    long = [page(f"<div class='s1'>{'side ' * 3}{k}</div><div class='s2'><p>{'word ' * 200}{k}</p><p>{k}</p></div>", f"http://h{k % 4}.org/") for k in range(40)]
    short = [page("<div class='s1'>Of more words than the page itself</div><div class='s2'><p>Short</p></div>", "http://few.org/")]
    got = texts(spark, long + short)
    assert got[40] == "Short" and got[3] == f"{'word ' * 200}3\n3"


def test_text_in_elements_of_one_page_stays(spark):
    hero = "<div class='page'><div class='hero'>The site of all sites</div>{}</div>"
    numbered = [page(hero.format(f"<article id='post-{k}'><p>Own story {k}</p></article>")) for k in range(50)]
    got = texts(spark, numbered)
    assert got == {k: f"Own story {k}" for k in range(50)}
    slugs = "abcdefghijklmnopqrstuvwxyz"
    named = [page(hero.format(f"<div id='{c}-story'><p>Own story of {c}, with more words than the other</p></div>")) for c in slugs]
    assert texts(spark, named) == {k: f"Own story of {c}, with more words than the other" for k, c in enumerate(slugs)}
    # a layout that one page in twenty has, with an element that most pages keep their text in
    usual = [page(f"<div class='top'>T{k}</div><div class='text'><h2>Head {k}</h2><p>Many words of the page of number {k}</p></div>") for k in range(38)]
    rare = [page(f"<div class='top'>T</div><div class='text'><h2>See below {k}</h2></div><div class='tale'><p>The tale {k}</p></div>") for k in range(2)]
    got = texts(spark, usual + rare)
    assert got[38] == "See below 0\nThe tale 0" and got[3] == "Head 3\nMany words of the page of number 3"


def test_names_made_from_titles_stay(spark):
    body = "<article><h2 id='related-work'>Related work {k}</h2><p>One {k} <math><mi>x</mi><mo>=</mo><mn>{k}</mn></math> more</p><section id='legal-history'><p>Law {k}</p></section><section id='comments-on-the-theory'><h3 id='search-algorithms'>Search</h3><p>Theory {k}</p></section><div class='legal-analysis'>A</div><section class='social-history'>B {k}</section><p class='alert-level'>C</p><div class='content-header'>D</div><div class='share-box'>Share it</div><section id='comments'><p>Nice</p></section></article>"
    rows = [page(body.format(k=k)) for k in range(30)] + [page("<article><p>Own</p><div class='legal-history'><p>Once only</p></div></article>")]
    got = texts(spark, rows)
    assert got == {k: f"Related work {k}\nOne {k} x={k} more\nLaw {k}\nSearch\nTheory {k}\nA\nB {k}\nC\nD" for k in range(30)} | {30: "Own\nOnce only"}
    plain = "<div id='cookie-notice'>We use cookies {k}</div><div class='site-footer'>Foot {k}</div><h2 id='related-work'>Head {k}</h2><p>Some words {k}</p>"
    rows = [page(plain.format(k=k) + ("<section id='legal-history'><p>Law</p></section>" if k == 7 else "")) for k in range(30)]
    assert texts(spark, rows) == {k: f"Head {k}\nSome words {k}" + "\nLaw" * (k == 7) for k in range(30)}


def test_names_of_boilerplate():
    named = ("div.ad", "div.shadow", "h2.comments", "section.comments", "div.adapter", "div.ad-box", "div.sidebar_left", "div.legal-analysis", "div.social-history", "section.#comments-on-style", "p.cookie-notice2")
    assert [template_html.boilerplate_name(k) for k in named] == [True, False, False, True, False, True, True, False, False, False, True]


def test_a_host_of_pages_equals_a_plain_reader(spark):
    """All pages of a table against a reader of the article element alone."""
    import html
    import re

    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in queries.op4_template_text(spark, "/root/testdata/sf0.01").collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (text, len(text))
    assert math.isclose(len(got), df.count())
