"""Centroid clusters, main texts and the filter audit against brute force, with their odd rows."""

import hashlib
import html
import itertools
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from strandlens.llm import centroids, filter_audit, main_text, queries

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- centroids


def k_means(rows, k=16, rounds=3, size=64):
    """Plain Python, with whole numbers of any size."""
    kept = [(i, [math.floor(n * 64 / d) if d == 1 else (n * 64) // d for n, d in (float(x).as_integer_ratio() for x in v)]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(b"1:%d" % (r[0] or 0)).hexdigest() if r[0] is not None else "", r[1]))
    where = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(where))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(nearest(v)[1], []).append(v)
        where = [[sum(c) // len(held[j]) for c in zip(*held[j])] if j in held else c for j, c in enumerate(where)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in where]
    fit = lambda n: n if n < 1 << 63 else None
    return sorted(((i, j, fit(d), fit(inertia[j]), fit(sum(inertia.values())), digest[j]) for i, j, d in found), key=repr)


def found_clusters(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, cluster int, ids string")


def test_clusters_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.gauss(i % 5, 1))) for _ in range(64)]) for i in range(300)]
    rows += rows[:3] + [(7, rows[8][1]), (None, rows[9][1]), (400, None), (401, []), (402, [1.0] * 63), (403, [None] + [1.0] * 63), (404, [float("nan")] * 64), (405, [float("inf")] + [0.0] * 63)]
    assert found_clusters(centroids.clusters(vectors(spark, rows))) == k_means(rows)


@pytest.mark.parametrize("size", [1e5, 1e7, 1e15, 1e30])
def test_clusters_of_large_numbers(spark, size):
    """Beyond 2^53 in 64-bit integers, beyond 2^63 in Python's."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * size for _ in range(64)]) for i in range(40)]
    assert found_clusters(centroids.clusters(vectors(spark, rows, "double"))) == k_means(rows)


def test_clusters_of_few_or_equal_vectors(spark):
    few = [(i, [float(i)] * 64) for i in range(5)]
    assert found_clusters(centroids.clusters(vectors(spark, few))) == k_means(few)
    same = [(i, [0.5] * 64) for i in range(40)]  # ties: the smallest number
    assert found_clusters(centroids.clusters(vectors(spark, same))) == k_means(same)
    assert {r.cluster for r in centroids.clusters(vectors(spark, same)).collect()} == {0}
    empty = centroids.clusters(vectors(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(TypeError):
        centroids.clusters(spark.createDataFrame([("a", [1.0] * 64)], "vec_id string, embedding array<double>"))


def test_distances_in_all_three_kinds():
    rng = np.random.default_rng(1)
    for most, kind in ((1000, np.int64), (1 << 25, np.int64), (1 << 27, np.int64), (1 << 40, object)):
        x, c = rng.integers(-most, most, (50, 64)), rng.integers(-most, most, (7, 64))
        got = centroids.distances(x, c)
        assert got.dtype == kind
        assert got.tolist() == [[sum((int(p) - int(q)) ** 2 for p, q in zip(a, b)) for b in c] for a in x]
    for values in (np.array([[1, -2]]), np.array([[1 << 20, 0]]), np.array([[1 << 40, -5]]), np.array([[1 << 80, -5]], dtype=object)):
        assert centroids.unpacked(*centroids.packed(values), 2).tolist() == values.tolist()
    assert centroids.added(np.array([(1 << 63) - 1]), np.array([1])).tolist() == [1 << 63]


def test_cluster_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{SF}/embeddings.parquet'")
    assert found_clusters(queries.op11_centroid_clusters(spark, SF)) == sorted(con.sql(centroids.sql()).fetchall(), key=repr)


# ---------------------------------------------------------------- pages


def test_pages_equal_their_articles(spark):
    """The given pages mark their article: its markup is a few tags, so a pattern is brute force enough."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.op12_main_text(spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        inside = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        text = " ".join(html.unescape(re.sub("</?(?:p|h1|br)>", " ", inside).replace("<b>", "").replace("</b>", "")).split())
        assert (r.text, r.n_chars) == (text, len(text))


LONG = "The long paragraph of an article has quite a few words, more than any notice beside it would have. " * 3
BODY = f"<h1>Title</h1><p>{LONG}</p><p>To.</p><p>A <b>bo</b>ld &lt;nav&gt; &amp; so on</p>"
WANTED = f"Title {LONG.strip()} To. A bold <nav> & so on"
EVERYTHING = [
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav>",
    "<div class='cookie-notice'>We use cookies on this page, and we ask you to agree to all of them before you read any further.</div>",
    "<header><h2>Site</h2><p>All the news of the day and of the night, every day and every night of the year.</p></header>",
    "<aside><p>Other things to read when you are done with this, and more of them, and more of them.</p></aside>",
    "<div id='sidebar'><div><p>Deep inside a sidebar there is a text of about the length of a short paragraph.</p></div></div>",
    "<form><label>Your address</label><input type=text><button>Send it to us now</button></form>",
    "<div class=\"ad\">Buy this now, it is cheaper than it was a week ago &gt; see for yourself.</div>",
    "<script>var a = '<p>not text</p></div>';</script><style>p > a {color: red}</style><!-- <p>nor this</p> -->",
    "<section class='comments'><h3>Comments</h3><article><p>I read this and I have something to say about it, at some length.</p></article></section>",
    "<footer>&copy; the owner of this page and of all the others, with all rights reserved for all times.</footer>",
]


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main><div>%s</div></main>", "<div role='main'>%s</div>", "<div class='post-content'>%s</div>", "<div id=content><div><div>%s</div></div></div>", "<section>%s</section>"])
def test_articles_among_everything_else(around):
    page = "<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join(EVERYTHING[:8]) + around % BODY + "".join(EVERYTHING[8:]) + "</body></html>"
    assert main_text.main_text(page) == WANTED
    assert main_text.main_text(page[: page.index("<footer")]) == WANTED  # the end is missing
    inner = BODY.replace("<p>To.", "".join(EVERYTHING[:2] + EVERYTHING[3:9]) + "<p>To.")
    assert main_text.main_text("<body>" + EVERYTHING[0] + around % inner + EVERYTHING[9] + "</body>") == WANTED


def test_regions_of_pages_without_names():
    menu = "<div>" + "".join(f"<a href='{i}'>a link of the menu {i}</a> " for i in range(9)) + "</div>"
    page = f"<body>{menu}<hr><p>{LONG}</p><p>To.</p><p>{LONG}</p><hr><div>A short line at the end</div></body>"
    assert main_text.main_text(page) == f"{LONG.strip()} To. {LONG.strip()}"
    assert main_text.regions(np.array([0, 10, 0, 0, 0, 50, 60, 0, 5, 0, 0, 0, 90])) == [(5, 9), (12, 13)]
    assert main_text.regions(np.array([0, 10, 0, 0, 0, 20])) == [(5, 6)]  # nothing surges: the largest
    assert main_text.regions(np.zeros(4, dtype=int)) == [] and main_text.regions(np.zeros(0, dtype=int)) == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("no markup at all", "no markup at all"),
        ("a < b and b > c", "a < b and b > c"),
        ("<nav>x</nav>", ""),
        ("<nav><ul><li>never closed<article><p>Text</p></article>", "Text"),
        ("<p>One<p class=notice>Notice<p>Two &am &amp &#233;&nbsp; three\n\tfour", "One Two &am & é three four"),
        ("<article><p>Only <a href=x>a link</a></p><ul><li><a href=y>1</a><li><a href=z>2</a></ul></article>", "Only a link 1 2"),
        ("<p>a<br>b<b>c</b>d</p><script>never closed <p>x", "a bcd"),
        ("<p title=\"a > b\">x</p><p hidden>y</p><p title='hidden'>z</p><div style='display: none'>w</div>", "x z"),
        ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T x"),
        ("<DIV CLASS='Ad'>x</DIV><P>y</P>", "y"),
        ("<div class='with-sidebar'><p>kept</p></div>", "kept"),
    ],
)
def test_odd_pages(page, text):
    assert main_text.main_text(page) == text


def test_page_tables(spark):
    long = "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>"
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None), (2, "v", long, "y")]
    got = main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    want = " ".join([LONG.strip()] * 3000)
    assert sorted(got.collect(), key=repr) == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, "v", want, len(want))], key=repr)
    assert main_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    nested = "<div class=ad>" * 2000 + "x" + "</div>" * 2000 + "<nav>" * 2000 + "y"
    assert main_text.main_text(nested) == "y"


# ---------------------------------------------------------------- filters


def audited(docs, labels):
    """(part, order, step) -> counts, document by document."""
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            good, bad = marks.get(i, (False, False))
            marks[i] = (good or quality == 1, bad or toxic == 1)
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    rows = []
    for i, t, part in docs:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and least[text] < i,
        }
        rows.append((part or "", {f for f, v in fails.items() if v}, *marks.get(i, (False, False))))
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter(next(f for f in order if f in fails) for _, fails, _, _ in mine if fails for order in orders)
        for order in orders:
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [r for r in mine if f in r[1] and not r[1] & before]
                out[part, order, step] = (
                    sum(not r[1] & (before | {f}) for r in mine),
                    len(removed),
                    sum(f in r[1] and bool(r[1] & before) for r in mine),
                    sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in removed),
                    sum(r[3] for r in removed),
                    shapley[f],
                )
    return out


def frames(spark, docs, labels):
    d = spark.createDataFrame([(i, t, s, 1, b"x", 5) for i, t, s in docs], "doc_id long, text string, source string, mask int, digest binary, good int")
    return d.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def some_texts(rng):
    words = [f"w{i}" for i in range(200)] + ["Aa", "BBB", "é", "#x", "50%"]
    return [rng.choice([" ", "\n", "\t", "\x0b"]).join(rng.choice(words[: rng.choice([20, 200, 205])]) for _ in range(rng.choice([0, 1, 49, 50, 51, 120]))) for _ in range(60)]


def test_audit_equals_brute_force(spark):
    rng = random.Random(5)
    texts = some_texts(rng)
    docs = [(i, rng.choice(texts), rng.choice(["a", "b", "", None, "hot", "hot"])) for i in range(250)]
    docs += [docs[3], docs[3], (7, "another text of one id", "a"), (None, texts[0], "a"), (None, None, None), (300, None, "b"), (301, "", "b"), (-4, texts[1], "a"), (302, "A\x1cB " * 400000, "b")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(200)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1), (9999, 1, 1)]
    got = filter_audit.audit(*frames(spark, docs, labels)).collect()
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in got} == audited(docs, labels) and len(got) == 600 * 4


def test_audit_of_empty_tables_and_bad_ids(spark):
    assert filter_audit.audit(*frames(spark, [], [])).collect() == []
    assert len(filter_audit.audit(*frames(spark, [(1, "x", "s")], [])).collect()) == 600
    with pytest.raises(TypeError):
        filter_audit.audit(spark.createDataFrame([("a", "b", "c")], "doc_id string, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int"))


def test_chains_tell_texts_of_one_fingerprint_apart(monkeypatch):
    chains = filter_audit.Chains()
    assert [chains.add(1, t, i) for t, i in ((b"a", 5), (b"b", 4), (b"a", 5), (b"a", 9), (b"a", 2), (b"b", 4), (b"b", 6))] == [None, None, None, 9, 5, None, 6]
    assert list(chains.each()) == [(1, b"a", 2), (1, b"b", 4)]
    # sent in small lots, from several tasks, in any order: the same ids
    monkeypatch.setattr(filter_audit, "HELD_BYTES", 10)
    rng = random.Random(2)
    rows = [type("Row", (), {"text": rng.choice(["x", "yy", "z" * 20, None, ""]), "doc_id": i}) for i in range(200)]
    rng.shuffle(rows)
    routed = [e for k in range(4) for e in filter_audit.sent(rows[k::4])]
    rng.shuffle(routed)
    found = {i for i, _ in filter_audit.copies(routed)}
    least = {}
    for r in rows:
        least[r.text or ""] = min(least.get(r.text or "", r.doc_id), r.doc_id)
    assert found == {r.doc_id for r in rows if least[r.text or ""] < r.doc_id}


def test_words_over_pieces(monkeypatch):
    text = "aa bb\tcc\x0bdd  ee ff\x1cgg " * 30
    whole = filter_audit.condition_mask(text.encode(), len(text))
    monkeypatch.setattr(filter_audit, "PIECE", 4)
    assert filter_audit.condition_mask(text.encode(), len(text)) == whole
    assert b"".join(filter_audit.pieces(text.encode())) == text.encode()
    assert sum(len(p.split()) for p in filter_audit.pieces(text.encode())) == len(re.findall(r"[^\x20\x09-\x0D]+", text))


def test_audit_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    assert sorted(map(tuple, queries.op13_filter_audit(spark, SF).collect())) == sorted(con.sql(filter_audit.sql()).fetchall())


def test_order_tables_agree():
    kept, removed, redundant, only = filter_audit.order_tables()
    assert kept.shape == (600, 32) and pa.array(removed.sum(axis=1)).to_pylist() == [16, 8, 4, 2, 1] * 120
    assert (only.sum(axis=1) == 1).all() and ((removed + redundant).sum(axis=1) == 16).all()
