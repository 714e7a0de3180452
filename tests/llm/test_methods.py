"""The operators' methods: whole prefixes, robust estimates, chains, merges, rules, clashing columns, streamed archives."""

import base64
import hashlib
import itertools
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from matchloom.llm import bpe, chat, decontaminate, licenses, lm, minhash, quality, toxicity, url_filters, warc


def turns(spark, n, text="answer"):
    return spark.createDataFrame([(1, t, "assistant" if t % 2 else "user", f"{text} {t}") for t in range(n)], "conv_id long, turn long, role string, text string")


def test_numbered_turns_over_many(spark):
    numbered = lambda ts: "".join(f"{i}. {r}: {x}\n" for i, (r, x) in enumerate(ts))
    got = chat.render(turns(spark, 150), numbered).orderBy("position").collect()
    assert "".join(r.piece for r in got) == numbered([(r.role, r.piece.split(": ", 1)[1][:-1]) for r in got])
    assert [r.piece for r in got][149] == "149. assistant: answer 149\n" and not any(r.rewrites for r in got)


def test_late_rewrite_is_flagged(spark):
    late = lambda ts: "".join(f"[{r}] {'...' if i == 1 and len(ts) > 40 else x}\n" for i, (r, x) in enumerate(ts))
    got = chat.render(turns(spark, 60), late).orderBy("position").collect()
    assert [r.position for r in got if r.rewrites] == [40]


def test_bounded_templates(spark):
    """Restarts change nothing for a template that keeps its word, and one that doesn't goes on with whole prefixes."""
    plain = lambda ts: "<s>" + "".join(f"({r}) {x};" for r, x in ts)
    numbered = lambda ts: "".join(f"{i}. {x}\n" for i, (_, x) in enumerate(ts))
    for template in (plain, numbered):
        whole = [r.piece for r in chat.render(turns(spark, 90), template).orderBy("position").collect()]
        short = [r.piece for r in chat.render(turns(spark, 90), chat.bounded(4)(lambda ts, t=template: t(ts))).orderBy("position").collect()]
        assert whole == short and len(whole) == 90


def determinant(x, floors, n):
    return np.linalg.slogdet(np.cov(x.T, bias=True) * n + np.diag(np.square(floors)))[1]


def test_least_determinant(spark):
    """The estimate's determinant against that of the best of all subsets."""
    rng = np.random.default_rng(3)
    floors, share = [0.05, 0.05], 0.75
    rows, data = [], {}
    for g in range(6):
        x = rng.normal(size=(12, 2)) @ np.array([[1.0, 0.6], [0.0, 0.5]])
        x[:3] += [6, -5] if g % 2 else [9, 9]
        data[g] = x
        rows += [(g, *map(float, r), int(k % 4)) for k, r in enumerate(x)]
    base = spark.createDataFrame(rows, "g int, __x0 double, __x1 double, __part int").repartition(3)
    scale = quality.consistency(share, 2) * (1 + 4 / 9)
    for r in quality.estimates(base, ["g"], floors, share=share).collect():
        best = min(determinant(data[r.g][list(s)], floors, scale) for s in itertools.combinations(range(12), 9))
        assert best - 1e-9 <= r["__det"] <= best + 0.05
        assert np.linalg.norm([r["__m0"], r["__m1"]]) < 1.5


def test_consistency():
    """Known chi-square values; and the factor against normal rows."""
    assert abs(quality.chi_square(11.0705, 5) - 0.95) < 1e-4 and abs(quality.chi_square(0.4549, 1) - 0.5) < 1e-4
    x = np.random.default_rng(1).normal(size=(200000, 5))
    d = (x**2).sum(1)
    near = x[d <= np.quantile(d, 0.75)]
    assert abs(near.var() * quality.consistency(0.75, 5) - 1) < 0.01 and quality.consistency(1.0, 5) == 1


def brute_verdicts(rows, cutoff):
    """The same estimate by plain numpy: starts, two steps each, the least determinant, two more."""
    n, floors = 5, np.array([f for _, f in quality.FEATURES.values()])
    scale = quality.consistency(0.75, n)
    at = lambda v, q: np.sort(v)[max(0, int(np.ceil(q * len(v))) - 1)]

    def of(x, s):
        m = x.mean(0)
        return m, np.cov(x.T, bias=True).reshape(n, n) * s * (1 + 2 * n / len(x)) + np.diag(floors**2)

    def far(x, e):
        y = x - e[0]
        return (y * np.linalg.solve(e[1], y.T).T).sum(1)

    def step(x, e):
        d = far(x, e)
        return of(x[d <= at(d, 0.75) * (1 + 1e-12)], scale)

    out = {}
    for key in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == key]
        x, part = np.array([r[2] for r in group]), np.array([r[3] for r in group])
        mid = np.array([at(c, 0.5) for c in x.T])
        mad = np.array([at(np.abs(c - m), 0.5) for c, m in zip(x.T, mid)])
        starts = [(mid, np.diag((mad * 1.4826) ** 2 + floors**2)), of(x, 1.0), *[of(x[part == p], 1.0) for p in sorted(set(part))]]
        ends = [step(x, step(x, e)) for e in starts]
        e = min(ends, key=lambda e: np.linalg.slogdet(e[1])[1])
        e = step(x, step(x, e))
        for r, d in zip(group, far(x, e)):
            out[r[1]] = d
    return out


def test_verdicts_against_plain_numpy(spark):
    """Small, tiny and null groups, ties and outliers."""
    rng = random.Random(8)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    docs = []
    for i in range(220):
        t = [word(rng.randint(3, 7)) for _ in range(rng.randint(25, 90))]
        if i % 17 == 0:
            t = [w + "###|$" for w in t]
        if i % 23 == 0:
            t = [w.upper() * 3 for w in t]
        docs.append((i, " ".join(t), rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", None]) if i % 50 else "alone"))
    docs += [(500, docs[1][1], "en", "a"), (501, docs[1][1], "en", "a"), (502, None, None, None), (503, "", "xx", "yy")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(4)
    got = quality.judge(df).collect()
    stats = spark.createDataFrame(got, quality.judge(df).schema)
    x = stats.select("doc_id", "lang", "source", *[c().alias(f"x{i}") for i, (c, _) in enumerate(quality.FEATURES.values())])
    x = x.withColumn("part", F.pmod(F.xxhash64(*[f"x{i}" for i in range(5)]), F.lit(4)))
    rows = [((r.lang, r.source), r.doc_id, [r[f"x{i}"] for i in range(5)], r.part) for r in x.collect()]
    want = brute_verdicts(rows, quality.CUTOFF)
    assert len(got) == len(docs)
    for r in got:
        assert abs(r.distance - want[r.doc_id]) <= 1e-6 * max(1, want[r.doc_id])
        assert r.kept == (not r.base_failed and want[r.doc_id] <= quality.CUTOFF)
    assert any(not r.kept and not r.base_failed for r in got) and sum(r.kept for r in got) > 150


def test_chain_against_plain_fits():
    """Out-of-fold inputs and the order of the chain, by gradient descent on the same penalty."""
    rng = np.random.default_rng(5)
    x = (rng.random((120, 4)) < 0.4).astype(float)
    labels = np.column_stack([x[:, 0], np.maximum(x[:, 1], rng.random(120) < 0.1), np.maximum(x[:, 0], x[:, 2])]).astype(int)
    folds = np.arange(120) % 3

    def plain(x, y):
        w, b = np.zeros(x.shape[1]), 0.0
        for _ in range(30000):
            e = 1 / (1 + np.exp(-(x @ w + b))) - y
            w -= 0.01 * (x.T @ e + 0.5 * w)
            b -= 0.01 * (e.sum() + 1e-3 * b)
        return w, b

    chain = toxicity._chain(x, np.arange(4, dtype=np.uint64), labels, folds, ["a", "b", "c"], 0.5)
    now = x
    for c in range(3):
        w, b = plain(now, labels[:, c])
        assert np.allclose(chain.weights[c], w, atol=1e-3) and abs(chain.biases[c] - b) < 1e-3
        oof = np.zeros(120)
        for f in range(3):
            w, b = plain(now[folds != f], labels[folds != f, c])
            oof[folds == f] = 1 / (1 + np.exp(-(now[folds == f] @ w + b)))
        now = np.column_stack([now, oof])


def merged(piece, ranks):
    """Byte-pair merges of one pre-token, the least rank first, the leftmost of equal ones."""
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_bpe_against_plain_merges(spark):
    import public_tokenizers as P

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    rng = random.Random(2)
    some = "the ring 12345 Träne été    \n\n niño's  don't x_y 日本語 ...!? \t🙂 ".split(" ")
    texts = ["", None, " ", "\n \n", "a" * 700, "7" * 900, "x " * 40 + "=" * 400 + " end " * 60, *[" ".join(rng.choice(some) for _ in range(rng.randint(1, 400))) for _ in range(30)]]
    docs = spark.createDataFrame([(None if i == 9 else f"id{i}", t) for i, t in enumerate(texts)], "doc_id string, text string").repartition(3)
    want = []
    for i, t in enumerate(texts):
        ids = [x for m in regex.findall(P.PATTERN, t or "") for x in merged(m.encode(), ranks)]
        want.append((None if i == 9 else f"id{i}", len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (100, 32), (64, 64)):
        got = [tuple(r) for r in bpe.digests(bpe.encode(docs, chunk=chunk, overlap=overlap)).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    parts = bpe.encode(docs.filter("doc_id = 'id36'"), chunk=100, overlap=32)
    assert parts.count() == parts.first().parts > 3
    dec = docs.selectExpr("cast(length(text) as decimal(12,2)) as doc_id", "text")
    assert bpe.digests(bpe.encode(dec, chunk=100, overlap=32)).count() == len(texts)


def test_long_documents_of_the_tables_come_in_chunks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert bpe.encode(docs).filter("parts > 1").count() > 0


def test_links_of_pages(spark):
    page = "http://a.org/x/y?q=1"
    cases = {"http://b.org/z": "http://b.org/z", "//c.org/k": "http://c.org/k", "/r": "http://a.org/r", "s": "http://a.org/x/s", "../t": "http://a.org/t", "./u?v=1": "http://a.org/x/u?v=1", "?w": "http://a.org/x/y?w", "#top": None, "": None, "mailto:x@y": None}
    df = spark.createDataFrame([(page, k) for k in cases], "u string, t string")
    got = {r.t: r.r for r in df.select("t", url_filters.resolved(F.col("u"), F.col("t")).alias("r")).collect()}
    assert got == cases
    html = "<LINK href='/one' rel=canonical><link rel=\"canonical\" href=\"/two\"><meta content=\"0; URL='http://d.org/'\" http-equiv=refresh><link rel=icon href=/no>"
    edges = url_filters.html_edges(spark.createDataFrame([(page, html), (page, None)], "url string, html string")).collect()
    assert sorted(r.target for r in edges) == ["http://a.org/one", "http://a.org/two", "http://d.org/"]


def test_redirects_carry_decisions(spark):
    """Chains of redirects of any length, a block and an allow in one component, over columns with clashing names."""
    rules = [url_filters.Rule("block", "bad.com", "/"), url_filters.Rule("allow", "good.com", "/")]
    urls = ["http://bad.com/a", "http://p1.org/", "http://p2.org/", "http://good.com/", "http://q1.org/", "http://q2.org/", "http://free.org/", None]
    pages = spark.createDataFrame([(i, u, "r", "h", "p", "v", "x") for i, u in enumerate(urls)], "page_id long, url string, root string, host string, path string, verdict string, node string")
    hops = [(0, 1), (1, 2), (0, 4), (4, 5), (5, 3)]
    edges = lambda pairs: spark.createDataFrame([(urls[a], urls[b]) for a, b in pairs], "url string, target string")
    first = {r.page_id: r.verdict for r in url_filters.judge(pages, rules, edges(hops[:2])).collect()}
    assert [first[i] for i in range(8)] == ["block", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    got = url_filters.judge(pages, rules, edges(hops))
    second = {r.page_id: r.verdict for r in got.collect()}
    assert [second[i] for i in range(8)] == ["block", "allow", "allow", "allow", "allow", "allow", "allow", "allow"]
    assert {r.root for r in got.collect()} == {"r"} and {r.node for r in got.collect()} == {"x"}


def test_many_license_rules(spark):
    """Thousands of sentences and rules; a rule inside a longer one yields."""
    known = {f"s{i}": f"Clause number {i} of this license applies." for i in range(2000)}
    rules = [(f"r{i}", f"L{i}", [f"s{i}", f"s{i + 1}"]) for i in range(0, 1500, 2)] + [("long", "LL", ["s0", "s1", "s2"])]
    texts = ["\n".join(known[f"s{i}"] for i in (0, 1, 2)), "\n".join(known[f"s{i}"] for i in (10, 11)), known["s11"] + " " + known["s10"], "none", None]
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    got = {r.doc_id: (r.matched_rules, r.licenses) for r in licenses.scan(df, known=known, rules=rules).collect()}
    assert got == {0: (["long"], ["LL"]), 1: (["r10"], ["L10"]), 2: ([], []), 3: ([], []), 4: ([], [])}


def test_archives_as_streams(spark, tmp_path):
    import pyarrow.fs as fs

    parts = [warc.record(i, f"http://a/{i}", bytes([65 + i % 26]) * (i * 997), None if i % 5 else i - 1 if i else None) for i in range(60)]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(parts))
    (tmp_path / "bad.warc.gz").write_bytes(b"".join(parts[:3]) + parts[3][:20])
    df = spark.createDataFrame([(f"file://{tmp_path}/x.warc.gz",), (f"file://{tmp_path}/bad.warc.gz",)], "path string")
    got = warc.read_files(df).collect()
    whole = [r for r in got if "bad" not in r.path]
    assert [r.page_id for r in whole] == list(range(60)) and all(r.error is None for r in whole)
    assert all(len(r.payload) == r.page_id * 997 for r in whole if r.record_type == "response")
    assert [bool(r.error) for r in got if "bad" in r.path] == [False] * 3 + [True]
    assert fs.FileSystem.from_uri(f"file://{tmp_path}/x.warc.gz")


def test_wrong_length_is_told():
    import zlib

    text = zlib.decompress(warc.record(3, "u", b"abc", None), 31)
    for wrong in (text.replace(b"Content-Length: 3", b"Content-Length: 4"), text[:-4] + b"\r\n"):
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        assert next(warc.read_records(pack.compress(wrong) + pack.flush()))["error"]


CLASH = "n_words root node class_id kept distance p_toxic is_toxic spans items sentence_ids licenses __x0 part parts ids score trained key words digest first".split()


@pytest.mark.parametrize("op", ["lm", "toxicity", "quality", "minhash", "licenses", "bpe", "decontaminate", "chat", "warc"])
def test_clashing_columns(spark, op):
    """Further columns named like an operator's own change nothing in its result."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice("one two three four five six seven idiot".split()) for _ in range(rng.randint(20, 60))) for _ in range(40)] + [None, ""]
    plain = spark.createDataFrame([(i, t, "en", "a", "user", f"http://a/{i}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, role string, url string").repartition(2)
    more = plain.select("*", *[F.lit("own").alias(c) for c in CLASH])
    labels = plain.select("doc_id", F.lit(1).alias("quality"), F.col("text").contains("idiot").cast("int").alias("toxic"))
    bench = plain.filter("doc_id in (1, 2)").select(F.col("doc_id").alias("item_id"), "text")

    def result(df):
        if op == "lm":
            out = lm.score(df, train=F.col("doc_id") % 3 != 0).select("doc_id", F.round("score", 6))
        elif op == "toxicity":
            out = toxicity.score(df, toxicity.fit(df, labels)).select("doc_id", "is_toxic", F.round("p_toxic", 6))
        elif op == "quality":
            out = quality.judge(df).select("doc_id", "n_words", "kept", F.round("distance", 6))
        elif op == "minhash":
            out = minhash.classes(df)
        elif op == "licenses":
            out = licenses.scan(df).select("doc_id", "n_sentences", "licenses", "sentence_ids")
        elif op == "bpe":
            out = bpe.digests(bpe.encode(df, chunk=64, overlap=32))
        elif op == "decontaminate":
            out = decontaminate.report(df, bench, block_bytes=100).select("doc_id", "n_words", "n_hit", "items_sha256")
        elif op == "chat":
            out = chat.digests(chat.render(df, id_col="lang", turn_col="doc_id"))
        else:
            out = warc.read_archives(warc.write_archives(df, id_col="doc_id", payload_col="text")).select("page_id", "payload_digest", "record_type", "error")
        return sorted(map(str, out.collect()))

    want = result(plain)
    assert want and result(more) == want
