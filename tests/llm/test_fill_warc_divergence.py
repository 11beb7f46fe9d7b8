import gzip
import hashlib
import re
import sys
from base64 import b32encode
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tessera.llm")
from tessera.llm import divergence, fill_middle, warc  # noqa: E402

# ---- fill in the middle


def rearranged(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_rearranged_texts_match_brute_force(spark):
    odd = ["a<P>b", "<M>", "< P> <S", "\x00a\x00", "é" * 50 + "abc", "日本x語", "a" * 5000, "1" * 5000, "x y" * 40000, "\U0001F600a\U0001F600"]
    rows = X.rows() + [(1000 + i, t, *[None] * 8) for i, t in enumerate(odd)] + [(i, "some words, here", *[None] * 8) for i in range(2000, 2150)]
    docs = spark.createDataFrame(rows, X.SCHEMA).withColumns({c: F.lit(1) for c in ("n", "form", "output")}).repartition(3)
    got = fill_middle.fill_middle(docs)
    found = got.withColumn("back", fill_middle.restored()).collect()
    want = Counter(rearranged(r[0], r[1]) for r in rows)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found) == want
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert Counter(r.back for r in found) == Counter(r[1] or "" for r in rows)
    assert fill_middle.fill_middle(X.empty(spark)).count() == 0


def test_rank_index_is_exact_with_few_segments():
    rng = np.random.default_rng(3)
    steps = [rng.integers(1, 12, 50_000), np.ones(9000, int), rng.choice([1, 5000], 4000), np.full(3, 10**6), np.zeros(0, int), np.ones(1, int)]
    for gaps in steps:
        places = np.cumsum(gaps)
        for error in (3, 126):
            index = fill_middle.RankIndex(places, error)
            ranks = rng.permutation(len(places))
            assert np.array_equal(index.place(ranks), places[ranks])
            assert not len(places) or np.abs(index.residuals).max() <= error + 1
    assert len(fill_middle.RankIndex(np.cumsum(steps[0])).starts) < 200
    assert len(fill_middle.RankIndex(np.arange(100_000)).starts) == 1


# ---- WARC


PAGES = "page_id long, url string, html string, sha string, shard int, kind string, body string, k int"


def page_rows():
    texts = X.texts()
    rows = [(i * 13 % 89, f"http://h{i % 4}/{i}", t) for i, t in enumerate(texts)]
    rows += [(500 + i, None, texts[0]) for i in range(5)]  # copies
    rows += [(300, "http://same/", "<html>repeated row</html>")] * 7  # one row seven times
    rows += [(None, "http://none/", texts[1]), (None, None, "only with null ids"), (None, "http://x/", "only with null ids"), (7, "bad\r\nX-Page-Id: 9", "ünï\r\n\r\nWARC/1.1"),
             (301, "http://twice/a", "same id, two urls"), (301, "http://twice/b", "same id, two urls"), (302, "u", ""), (303, "u", None)]
    return [(*r, "s", 1, "k", "b", 2) for r in rows]


def expected(rows, least=0):
    payload = [(r[2] or "").encode() for r in rows]
    first = {}
    for r, p in zip(rows, payload):
        key = (r[0] is None, r[0] or 0)
        first[p] = min(first.get(p, key), key)
    out, seen = [], set()
    for r, p in sorted(zip(rows, payload), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        alone = len(p) < least or ((r[0] is None, r[0] or 0) == first[p] and p not in seen)
        seen.add(p)
        digest = b32encode(hashlib.sha1(p).digest()).decode()
        out.append((r[0], len(p), digest, *(("response", None) if alone else ("revisit", None if first[p][0] else first[p][1]))))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 20])
def test_archives_read_back(spark, tmp_path, least):
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(4)
    target = str(tmp_path / "a")
    warc.write(pages, target, least_bytes=least, shard_bytes=20_000, roll_bytes=2_000)
    got = warc.read(spark, target).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows, least)
    assert {r.html for r in got if r.record_type == "response"} == {r[2] or "" for r in rows}
    assert all((r.html is None) == (r.record_type == "revisit") for r in got)
    ids = {r.record_id: r for r in got}
    assert len(ids) == len(got)
    for r in got:
        if r.record_type == "revisit":
            assert ids[r.refers_to_record].record_type == "response" and ids[r.refers_to_record].payload_digest == r.payload_digest
    assert Counter(r.url for r in got) == Counter(r[1].replace("\r\n", "%0D%0A") if r[1] else None for r in rows)
    files = sorted(Path(target).glob("*.warc.gz"))
    assert len(files) > 5 and {r.file for r in got} <= {f.name for f in files} and not list(Path(target, "_temporary").iterdir())
    # shards ascend with the ids, and any gzip reader reads a file as a whole
    order = [(r.page_id is not None, r.page_id or 0) for f in files for r in sorted((x for x in got if x.file == f.name), key=lambda x: (x.page_id is not None, x.page_id or 0))]
    assert order == sorted(order)
    assert all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") for f in files)
    # other partitions, same files
    again = str(tmp_path / "b")
    warc.write(pages.repartition(7, "html"), again, least_bytes=least, shard_bytes=20_000, roll_bytes=2_000)
    manifest = lambda x: sorted(tuple(r) for r in spark.read.parquet(f"{x}/{warc.MANIFEST}").collect())
    assert manifest(target) == manifest(again)


def test_only_listed_whole_files_are_read(spark, tmp_path):
    target = str(tmp_path / "a")
    warc.write(spark.createDataFrame(page_rows(), PAGES), target, shard_bytes=20_000)
    n = warc.read(spark, target, payload=False).count()
    files = sorted(Path(target).glob("*.warc.gz"))
    (Path(target) / "shard-999999-00000.warc.gz").write_bytes(files[0].read_bytes())
    assert warc.read(spark, target, payload=False).count() == n == len(page_rows())
    files[0].write_bytes(files[0].read_bytes()[:-40])
    with pytest.raises(Exception, match="within a record|not the file"):
        warc.read(spark, target).count()
    empty = str(tmp_path / "none")
    warc.write(spark.createDataFrame([], PAGES), empty)
    assert warc.read(spark, empty).count() == 0


def test_hot_repeated_row_spreads_over_shards(spark, tmp_path):
    pages = spark.range(30_000).select(F.lit(5).alias("page_id"), F.lit("u").alias("url"), F.lit("<p>hot</p>").alias("html"))
    target = str(tmp_path / "hot")
    warc.write(pages, target, shard_bytes=4 << 20)
    got = warc.read(spark, target)
    assert {(r.record_type, r.refers_to): r["count"] for r in got.groupBy("record_type", "refers_to").count().collect()} == {("response", None): 1, ("revisit", 5): 29_999}
    assert got.select("file").distinct().count() >= 4 and got.select("record_id").distinct().count() == 30_000


# ---- divergence


def audited(rows, least, top=50):
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    held, count, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = term.findall(X.fold(text))
        sources[lang].add(source)
        held[lang].update(set(terms))
        count[lang, source].update(terms)
    out = []
    for lang, own in sources.items():
        kept = [t for t, d in held[lang].items() if d >= least]
        whole = Counter({t: sum(count[lang, s][t] for s in own) for t in kept})

        def price(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = price(whole), {s: price(count[lang, s]) for s in own}
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            more = [(t, p[s][t] - q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, n in (("pair", pairs, None), ("term", more, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:n])]
    return sorted(out)


@pytest.mark.parametrize("least, side, leaf, k", [(2, 256, 16, 4), (1, 16, 4, 2), (3, 4, 4, 2), (1000, 16, 4, 4)])
def test_divergence_matches_brute_force(spark, least, side, leaf, k):
    rng = np.random.default_rng(5)
    rows = [(r[1], r[2], r[3]) for r in X.rows()] + [("Ünï ünï AbC abc ab3c é é  x_y{z}", "fr", "s"), (None, "fr", None), ("", "only", None), ("a b", None, None)]
    rows += [(" ".join(f"t{w}" for w in rng.zipf(1.5, 40) % 300), "zz", f"s{rng.zipf(1.6) % 40}") for _ in range(200)]
    rows += [("9 8 7", "zz", f"none{i}") for i in range(20)]  # groups without terms: all-zero rows
    rows = [(re.sub("t[0-9]+", lambda m: "".join(chr(97 + int(c)) for c in m[0][1:]), t) if t and lang == "zz" else t, lang, s) for t, lang, s in rows]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    docs = docs.withColumns({c: F.lit(1) for c in ("row", "col", "v", "n", "term", "docs", "total", "_p")}).repartition(3)
    got = divergence.divergence(docs, least_docs=least, side=side, leaf=leaf, k=k)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audited(rows, least)


def test_divergence_of_no_rows_and_huge_counts(spark):
    assert divergence.divergence(X.empty(spark)).count() == 0
    n, total, v = 10**13, 10**15, 10**7
    row = spark.createDataFrame([(n, total, v)], "n long, total long, v long").select(divergence._price("n", "total", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_zero_quadrants_are_priced_without_cells(spark):
    a = divergence._Block(np.array([3, 9]), np.array([0]), np.array([20]), np.array([50]), 100, [64, 16])
    b = divergence._Block(np.array([5]), np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), 100, [64, 16])
    whole = np.abs(a.price[:, None] - b.price[None]).sum(-1)
    cost = divergence.joint_cost(a, b, False, 64, [64, 16]) + 36 * np.abs(a.zero[:, None] - b.zero[None])
    assert np.array_equal(cost, whole)
