"""HTML extraction, hard negatives and the Merkle manifest against plain Python, with nulls, ties, copies and no rows."""

import hashlib
import html as html_lib
import random
import re
import zlib

import numpy as np
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from sensorstream.llm import hard_negatives, html_extract, merkle
from sensorstream.llm.catalog import llm_oracles, llm_queries, op11_site_style_tree, op12_segment_negatives, op13_merkle_manifest

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_its_sql(spark, name):
    assert compare(llm_queries()[name](spark, SMALL), duck(SMALL), llm_oracles()[name]) is None


# --- pages


def _texts(frame, **kw):
    return [(r["page_id"], r["text"]) for r in html_extract.extract(frame, keep=["page_id"], **kw).select("page_id", "__main.text").collect()]


def test_every_given_page_gives_its_article(spark):
    want = {}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html_lib.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        want[r["page_id"]] = (r["url"], "\n\n".join(b for b in blocks if b))
    got = op11_site_style_tree(spark, SMALL).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == want and len(got) == len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def _site(n, copies=0):
    """Pages without any telling name: a menu, a slogan, one to four paragraphs, a legal line; ``copies`` of one page."""
    rng, rows, bodies = random.Random(3), [], []
    for k in range(n):
        body = [" ".join(rng.choice("river stone light green cloud".split()) + str(rng.randrange(10**6)) for _ in range(12)) for _ in range(rng.randint(1, 4))]
        body = bodies[0] if 0 < k <= copies else body
        bodies.append(body)
        html = f"<body><div><div><a href=/>Home</a><a href=/x>News</a></div><div><b>All the news, number {k % 3}</b></div>" + "<div>" + "".join(f"<p>{p}" for p in body) + "</div><div>Copyright 2020 to 2024, every right kept</div></div></body>"
        rows.append((k, "http://Site.example/a", html))
    return rows, ["\n\n".join(b) for b in bodies]


@pytest.mark.parametrize("most", [html_extract.MAX_BROADCAST, 0])
def test_unnamed_boilerplate_goes_by_entropy(spark, most):
    rows, want = _site(40, copies=20)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = dict(_texts(frame, max_broadcast=most))
    assert [got[k] for k in range(40)] == want


def test_few_pages_and_no_host_are_no_evidence(spark):
    rows, _ = _site(4)
    rows += [(100 + k, None, h) for k, _, h in _site(9)[0]]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all(t.startswith("HomeNews\n\nAll the news") and t.endswith("every right kept") for _, t in _texts(frame))


def test_node_importance_is_the_entropy_of_its_forms(spark):
    rows = [(k, "http://h/", f"<div>same</div><p>{'ab'[k % 2] * (k + 9)}</p><i>{'x' if k < 4 else 'yz'[k % 2]}</i>") for k in range(8)]
    got = sorted(round(r["importance"], 6) for r in html_extract.site_style_tree(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    e = -sum(p * np.log(p) for p in (0.5, 0.25, 0.25)) / np.log(8)
    assert got == sorted([0.0, 0.0, 0.0, 0.0, 0.0, 1.0, round(e, 6)])  # page, div, its text, p, i; p's text; i's text


def test_pages_of_every_shape(spark):
    cases = {
        None: "", "": "", "  \n": "", "plain &lt;text&gt; &amp;amp; &#233;": "plain <text> &amp; é", "a < b": "a < b",
        "<p>one<br>two\n three<p>four": "one two three\n\nfour", "<b>x</b> <i>y</i>z": "x yz", "<!-- gone -->kept<!-- open": "kept",
        "<script>if (a<b) '</p>'</script>s<style>p{}</style>": "s", "<p>end <a href='x": "end", "<p title=it's>q</p>": "q",
        "<nav>n</nav><header>h</header><main><header><h1>T</h1></header>m<aside>a</aside></main><footer>f</footer>": "T\n\nm",
        "<article>A<div class='user-comments'>c</div><form><input>f</form></article><div>other</div>": "A",
        "<article class=comment>c</article><div>d</div>": "d", "<div id=cookieNotice>k</div><div class=adverb>d</div>": "d",
        "<div hidden>h</div><div style='display: none'>n</div><div aria-hidden=true>a</div><div role=navigation>r</div>v": "v",
        "<ul><li>1<li>2</ul><table><tr><td>a<td>b<tr><td>c</table>": "1\n\n2\n\na b\n\nc", "</p></div>x": "x", "<b><div>a</b>b</div>c": "ab\n\nc",
        "<p>" + "word " * 50000: ("word " * 50000).strip(), "<div>" * 3000 + "deep": "deep",
    }
    rows = [(k, "http://h.example/" if k % 2 else None, h, "clash", 7) for k, h in enumerate(cases)]
    frame = spark.createDataFrame(rows + rows[:1] + rows[3:4], "page_id long, url string, html string, text string, row int")
    out = html_extract.extract(frame)
    assert out.columns == [*frame.columns, "__main"]
    got = out.select("page_id", F.col("__main.text").alias("main"), "text", "row").collect()
    assert len(got) == len(rows) + 2 and all((r["text"], r["row"]) == ("clash", 7) for r in got)
    assert {r["page_id"]: r["main"] for r in got} == dict(enumerate(cases.values()))
    assert html_extract.extract(frame.limit(0)).count() == 0


# --- hard negatives


def _negatives(rows, positives=5, negatives=5):
    rows = [(i, v, lab, a) for i, v, lab, a in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v, _, _ in rows), default=0)
    x = np.array([np.floor(np.array(list(v) + [0.0] * (dim - len(v))) * 256) for _, v, _, _ in rows]).reshape(len(rows), dim)
    key = lambda s, k: (-s[k], rows[k][0] is None, rows[k][0] or 0)
    out = []
    for a, (i, _, lab, asked) in enumerate(rows):
        if asked:
            s = (x @ x[a]).astype(int).tolist()
            order = sorted((k for k in range(len(rows)) if k != a), key=lambda k: key(s, k))
            for p in [k for k in order if rows[k][2] == lab][:positives]:
                ok = [k for k in order if rows[k][2] != lab and 80 * s[p] <= 100 * s[k] <= 100 * s[p]][:negatives]
                out += [(i, rows[p][0], r + 1, rows[k][0], s[p], s[k]) for r, k in enumerate(ok)]
    return sorted(map(str, out))


def _vectors(n, dim, rng):
    centers = rng.normal(size=(6, dim))
    rows = []
    for k in range(n):
        v = (centers[rng.integers(6)] + 0.3 * rng.normal(size=dim)).tolist()
        rows.append((int(k // 2) if k % 11 == 0 else k, v, int(rng.integers(3)) if k % 3 else 0, k % 10 == 0))
    rows += [(None, rows[4][1], 1, False), (7000, None, 1, True), (7001, [1.0, None], 1, True), (7002, [float("nan")] * dim, 1, True)]
    rows += [(7003, [float("inf")] * dim, 1, True), (7004, rows[5][1], None, True), (7005, [0.5] * (dim // 2), 2, True), (7006, [], 1, True)]
    return rows + [rows[0], rows[10], rows[10]]


@pytest.mark.parametrize("dim", [3, 24])
def test_hard_negatives(spark, dim):
    rows = _vectors(400, dim, np.random.default_rng(dim))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, asked boolean").withColumn("block", F.lit("clash"))
    asked = hard_negatives.usable(frame, "vec_id", "embedding", F.col("label"), 256, F.col("asked"))
    for block_rows, chunk_rows in ((32768, 8192), (64, 16)):
        got = hard_negatives.mine(asked, block_rows=block_rows, chunk_rows=chunk_rows)
        assert sorted(map(str, map(tuple, got.collect()))) == _negatives(rows)


def test_hard_negatives_of_nothing(spark):
    frame = spark.createDataFrame([(1, [1.0], 0, True), (2, [1.0], 1, False)], "vec_id long, embedding array<double>, label int, asked boolean")
    usable = lambda f: hard_negatives.usable(f, "vec_id", "embedding", F.col("label"), 256, F.col("asked"))
    assert hard_negatives.mine(usable(frame)).count() == 0  # no positive
    assert hard_negatives.mine(usable(frame.limit(0))).count() == 0


def test_hard_negatives_of_the_given_vectors(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["label"] is not None and r["vec_id"] % 7 == 0 else r["label"], r["vec_id"] % 100 == 0) for r in table]
    got = op12_segment_negatives(spark, SMALL).collect()
    assert sorted(map(str, map(tuple, got))) == _negatives(rows) and got


def _unpacked(x, label):
    mean, dev, _ = hard_negatives.summaries(x)
    n = len(x)
    page = {"rid": np.arange(n), "id": np.arange(n), "label": label, "mean": mean, "dev": dev, "vector": x}
    return {k: np.ascontiguousarray(v).tobytes() for k, v in page.items()} | {"kind": "float64", "n": n, "dim": x.shape[1], "goal": b""}


def test_bounds_hold_and_spare_most_scores():
    rng = np.random.default_rng(1)
    level = np.repeat(rng.normal(0, 200, size=(40, 8)), 8, axis=1)  # 40 clusters, flat within segments of eight
    x = np.floor(level[rng.integers(40, size=2000)] + rng.normal(0, 6, size=(2000, 64)))
    everything = hard_negatives.Rows([_unpacked(x, np.zeros(2000, np.int64))])
    for mean, dev, length in everything.levels:
        middle, reach = length * (mean[:50] @ mean.T), dev[:50] @ dev.T
        assert (np.abs(x[:50] @ x.T - middle) <= reach + 1e-6 * (1 + np.abs(middle))).all()
    order = np.argsort(x.mean(1))
    pages = [_unpacked(x[order[k : k + 100]], np.zeros(100, np.int64)) | {"rid": order[k : k + 100].astype(np.int64).tobytes()} for k in range(0, 2000, 100)]
    q = hard_negatives.Rows([_unpacked(x[:100], np.zeros(100, np.int64))])
    best, scored = hard_negatives.search_positives(q, [hard_negatives.Rows([p]) for p in pages], 5)
    s = x[:100] @ x.T
    s[np.arange(100), np.arange(100)] = -np.inf
    assert (best.score == -np.sort(-s, axis=1)[:, :5]).all()
    assert scored < 0.2 * 100 * 2000


# --- Merkle manifest


def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _leaf(*fields):
    return _h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def _levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def _proof(levels, k):
    out = []
    for level in levels[:-1]:
        run = k // 3 * 3
        out.append(("".join(level[run:k]), "".join(level[k + 1 : run + 3])))
        k //= 3
    return out


def _manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
    trees = {g: _levels([_leaf(*r) for r in groups[g]]) for g in names}
    top = _levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for j, r in enumerate(groups[g]):
            steps, text = _proof(trees[g], j) + _proof(top, k), r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = _leaf(*r[:4], text)
            for before, after in steps:
                now = _h(before + now + after)
            out.append((r[0], trees[g][0][j], trees[g][-1][0], top[-1][0], _h("".join(a + b for a, b in steps)), now, now == top[-1][0]))
    return sorted(out, key=str)


def _doc_rows():
    rng = random.Random(5)
    rows = [(k, "hot" if k % 3 else f"s{k % 7}é", rng.choice(["en", None]), k if k % 5 else None, "line\n" * rng.randint(0, 3) + f"t{k}") for k in range(130)]
    rows += [(200, None, None, None, None), (201, "", "", 0, ""), (202, "lone", "x", 1, "a\n" * 30000), (None, "hot", "x", 1, "null id"), (None, None, None, 0, "n")]
    return rows + [rows[4]] * 40 + [rows[6]]


@pytest.mark.parametrize("band", [1, 7])
def test_merkle_manifest(spark, tmp_path, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    monkeypatch.setattr(merkle, "CHUNK", 3**band)
    rows = _doc_rows()
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    frame.withColumn("root", F.lit(1)).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, op13_merkle_manifest(spark, str(tmp_path)).collect()), key=str) == _manifest(rows)


def test_merkle_of_nothing_and_of_one(spark):
    fields, kind = ["doc_id", "source"], "doc_id long, source string, hash string, grp int, o int"
    assert merkle.manifest(spark.createDataFrame([], kind), fields).count() == 0
    out = merkle.manifest(spark.createDataFrame([(1, None, "h", 2, 3)], kind), fields)
    assert out.columns == ["doc_id", "source", "hash", "grp", "o", "__merkle"]
    r = out.collect()[0]
    assert (r["hash"], r["grp"], r["o"]) == ("h", 2, 3)
    m = r["__merkle"]
    assert m["leaf"] == m["subroot"] == m["root"] == m["folded_root"] == _leaf(1, None) and m["proof"] == [] and m["verified"]


def test_intervals_nest():
    tree = merkle.Tree([str(k) for k in range(100)], whole=True)
    for level, nodes in enumerate(tree.levels):
        ends = sorted((lo, hi) for lo, hi, _ in nodes.values())
        assert [lo for lo, _ in ends] == [0, *(hi for _, hi in ends[:-1])] and ends[-1][1] == 100
        assert all(lo % 3**level == 0 and bucket == lo // 3**level for bucket, (lo, _, _) in nodes.items())
