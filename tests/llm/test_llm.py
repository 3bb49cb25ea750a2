"""The corpus operators against plain versions, exact round trips and held-out accuracy; nulls, empties, ties, repeats, empty tables, clashing columns."""

import base64
import hashlib
import re
import time
import zlib
from collections import Counter
from contextlib import nullcontext
from pathlib import Path

import duckdb
import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from auralith import skew
from auralith.llm import byte_bpe, html_render, jaccard, license_scan, media_avi, mixture, quality_zstd, queries, rules_mcd, simhash, toxicity, url_filter
from auralith.session import checkpointed, shared_folder, tidy

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, f0 long"
ODD = [(1, None, None, None, None, 0.0, 1), (2, "", "en", "s", 0, 0.0, 1), (3, "word " * 5000, "en", "s", 25000, 0.0, 1), (4, "same text here for all of us", "en", "s", 28, 0.0, 1), (5, "same text here for all of us", "en", "t", 28, 0.0, 1),
       (5, "same text here for all of us", "en", "t", 28, 0.0, 1), (None, "no id at all", "de", "t", 12, 0.0, 1), (6, " \n\t ", "fr", None, 4, 0.0, 1), (7, "x" * 30000, "fr", "u", 30000, 0.0, 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, None if i == 3 else (i + 1) % 2) for i in range(1, 8)], "doc_id long, quality int, toxic int")


def test_bpe_is_exact(spark, odd):
    codec = byte_bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(1)
    chars = [chr(i) for i in [*range(0x250), 0x85, 0x2028, 0x3000, 0x1F600, 0x4E2D, 0x301]]
    texts = ["".join(rng.choice(chars, rng.integers(0, 40))) for _ in range(500)] + ["a" * 9999, "ab" * 5000, "<|endoftext|>"]
    for t in texts:
        ids = codec.encode(t).tolist()
        assert ids == enc.encode_ordinary(t) and codec.decode(ids) == t.encode()
    out = byte_bpe.digests(byte_bpe.round_trip(odd)).collect()
    assert len(out) == len(ODD)
    for r, (_, text, *_rest) in zip(sorted(out, key=str), sorted(((r[0], r[1]) for r in ODD), key=str), strict=False):
        assert r["decoded_sha256"] in {hashlib.sha256((t[1] or "").encode()).hexdigest() for t in ODD}


def test_quality_counts(spark, odd):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    got = {r["doc_id"]: r for r in rules_mcd.quality_rules(odd).collect()}
    assert len(rules_mcd.quality_rules(odd).collect()) == len(ODD)
    for i, text, *_ in ODD:
        w = word.findall(text or "")
        c = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = np.zeros(len(w), bool)
        for k in range(len(w) - 7):
            if c[tuple(w[k : k + 8])] > 1:
                covered[k : k + 8] = True
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), covered.sum())
        assert r["base_failed"] == (len(w) < 20 or 100 * covered.sum() > 30 * len(w)) and not (r["base_failed"] and r["kept"])


def test_quality_fallback_takes_all_rows(spark):
    """Sources and languages below MIN_GROUP are judged by estimates of the whole language and the whole table, not by themselves."""
    rng = np.random.default_rng(3)
    prose = lambda: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(60))
    junk = lambda: " ".join(f"#$|{'x' * 40}&%{k}" for k in rng.integers(0, 10**6, 60))
    rows = [(i, prose(), "en", "big") for i in range(500)] + [(1000, junk(), "en", "lone"), (1001, prose(), "en", "small"), (1002, junk(), "fr", "lone"), (1003, prose(), "de", "small")]
    got = {r["doc_id"]: r["kept"] for r in rules_mcd.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [got[i] for i in (1000, 1001, 1002, 1003)] == [False, True, False, True] and sum(got[i] for i in range(500)) > 490


def test_mixture_matches_sql(spark, odd):
    for docs in (spark.read.parquet(f"{DATA}/documents.parquet"), odd, odd.limit(0)):
        documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
        want = duckdb.sql(mixture.ORACLE).df() if len(documents) else documents
        got = mixture.mix(docs).select("doc_id", "size", "source_size", "target", "taken").toPandas()
        key = lambda d: sorted(map(str, d.values.tolist()))
        assert len(got) == len(want) and (not len(got) or key(got.astype(float)) == key(want[got.columns].astype(float)))


def brute(texts, radius=4):
    def fp(t):
        w = (t or "").encode().lower().split()
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    f = [fp(t) for t in texts]
    root = list(range(len(f)))
    find = lambda x: x if root[x] == x else find(root[x])
    for a in range(len(f)):
        for b in range(a):
            if (f[a] ^ f[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return f, [find(i) for i in range(len(f))]


@pytest.mark.parametrize("bucket", [4096, 3])
def test_simhash_components(spark, monkeypatch, bucket):
    """With small limits every entry goes through blocks, most at once, and every key is dealt over salts."""
    if bucket != 4096:
        monkeypatch.setattr(simhash, "BUCKET", bucket)
        monkeypatch.setattr(simhash, "BLOCK", 2)
        monkeypatch.setattr("auralith.skew.HEAVY", 2)
        monkeypatch.setattr("auralith.skew.SMALL", 0)
    rng = np.random.default_rng(2)
    base = [str(w) for w in rng.integers(0, 500, 300)]
    texts = [None, "", " ", "one two", "a b c d e"]
    for _ in range(40):
        w = base.copy()
        for k in rng.integers(0, 300, rng.integers(0, 4)):
            w[k] = "x" + str(k)
        texts.append(" ".join(w))
    texts += [" ".join(map(str, rng.integers(0, 900, 60))) for _ in range(40)]
    want, roots = brute(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if bucket != 4096:
        f = np.array(want, np.uint64).reshape(-1, 1)
        assert sum(len(a) for a, _ in simhash._forest(np.unique(f, axis=0), 0, 3, 4)) <= len(f)
    got = {r["doc_id"]: (r["f0"] % 2**64, r["component_id"]) for r in simhash.components(docs).collect()}
    assert got == {i: (want[i], roots[i]) for i in range(len(texts))}


def test_simhash_odd_rows(spark, odd):
    assert len(simhash.components(odd).collect()) == len(ODD) and simhash.components(odd.limit(0)).isEmpty()
    kept = simhash.remove_duplicates(odd, corpus_pipeline.COLUMNS).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 3, 4, 7]


def test_near_dedup_counts_similarity(spark):
    """Planted pairs on both sides of Jaccard 0.8, with fingerprints on both sides of 20 bits, against brute force."""
    rng, texts = np.random.default_rng(5), []
    for i in range(150):
        w = [f"w{i}x{k}" for k in range(60 + i)]
        texts.append(" ".join(w))
        c = w.copy()
        for k in rng.integers(0, len(w), rng.integers(1, 4)):
            c[k] = f"y{i}x{k}"
        texts.append(" ".join(c[: len(c) - int(rng.integers(0, 6))]))
    texts += ["a common line that many of the texts hold " + " ".join(f"z{i}x{k}" for k in range(i % 30)) for i in range(60)]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    f = [simhash.fingerprint(t, 5, 2) for t in texts]
    root, seen = list(range(len(texts))), Counter()
    find = lambda x: x if root[x] == x else find(root[x])
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            linked = 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both)
            if both:
                seen[linked, sum(((x ^ y) % 2**64).bit_count() for x, y in zip(f[a], f[b], strict=True)) <= 20] += 1
            if linked:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert min(seen[True, False], seen[False, True]) > 2  # fingerprints alone are wrong in both ways
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = [r["doc_id"] for r in simhash.remove_duplicates(docs, ["doc_id", "text"]).collect()]
    assert sorted(kept) == [i for i in range(len(texts)) if find(i) == i]


def test_near_dedup_keeps_no_sets(spark, monkeypatch):
    """While candidates are looked for, the shared folder holds less than a tenth of the shingle sets; and rounds of comparisons find what one finds."""
    texts = [" ".join(f"w{i}x{k}" for k in range(2000)) for i in range(120)] + [" ".join(f"w{i}x{k}" for k in range(4 * i, 2000)) for i in range(1, 120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    folder, held, candidates = Path(shared_folder(spark).removeprefix("file:")), [], jaccard.candidates
    size = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    monkeypatch.setattr(jaccard, "candidates", lambda sets: held.append(size()) or candidates(sets))
    before = size()
    kept = sorted(r["doc_id"] for r in simhash.remove_duplicates(docs, ["doc_id", "text"]).collect())
    # text 119 + i lacks 4 * i of 1996 shingles of text i
    assert kept == [*range(120), *[119 + i for i in range(1, 120) if 5 * (1996 - 4 * i) < 4 * 1996]]
    assert held[0] - before < 0.1 * 8 * 1996 * 120
    once, calls = jaccard._linked_once, []
    monkeypatch.setattr(jaccard, "_linked_once", lambda *a: calls.append(1) or once(*a))
    monkeypatch.setattr(jaccard, "ROUND", 1.5)
    assert sorted(r["doc_id"] for r in simhash.remove_duplicates(docs, ["doc_id", "text"]).collect()) == kept
    assert len(calls) > 2


def test_near_dedup_of_a_large_cluster(spark, monkeypatch):
    """Variants of one text that mostly don't link: candidates stay in proportion to the rows that file them, and groups are those of brute force; blocks and rounds of a cluster lose no link."""
    monkeypatch.setattr(jaccard, "ROUND", 1000)
    rng, base = np.random.default_rng(7), [f"w{k}" for k in range(130)]
    texts = [" ".join(f"x{i}y{k}" for k in range(20)) for i in range(20)]
    for i in range(240):
        w = base.copy()
        for k in rng.integers(0, 130, rng.integers(1, 9)):
            w[k] = f"v{i}x{k}"
        texts.append(" ".join(w))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]

    def links_of(texts_at):
        for a in texts_at:
            for b in texts_at:
                both = len(sets[a] & sets[b])
                if a > b and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                    yield a, b

    def smallest(links):
        root = list(range(len(texts)))
        find = lambda x: x if root[x] == x else find(root[x])
        for a, b in links:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        return [find(i) for i in range(len(texts))]

    want = sorted(set(smallest(links_of(range(len(texts))))))
    assert 60 < len(want) < 240
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.remove_duplicates(docs, ["doc_id", "text"]).collect()) == want
    # without any links known
    hashes = lambda text: simhash.shingles(text, 5)
    names = {jaccard.named(hashes(t))[:2]: i for i, t in enumerate(texts)}
    firsts = checkpointed(jaccard.firsts(docs, hashes, jaccard.common_hashes(docs, hashes)))
    found = checkpointed(jaccard.candidates(firsts.withColumn("group", F.col("s0")).withColumn("n", F.lit(126))))
    filed = firsts.agg(F.sum(F.size("first"))).first()[0]
    assert found.count() <= filed < 240 * 239 / 4
    monkeypatch.setattr(jaccard, "BLOCK", 9000)
    monkeypatch.setattr(jaccard, "ROUND", 2)
    keys = docs.select("doc_id", jaccard.text_key()).withColumn("n", F.lit(126))
    rows = spark.createDataFrame([(*s, i) for s, i in names.items()], "s0 long, s1 long, doc_id long").join(keys, "doc_id").withColumn("root", F.struct("s0", "s1"))
    ties = found.where("tied").drop("tied")
    members = {names[r[k], r[k + 1]] for r in ties.collect() for k in (0, 2)}
    got = [(names[r[0], r[1]], names[r[2], r[3]]) for r in jaccard.links_inside(ties, rows, docs, hashes).collect()]
    true = set(links_of(sorted(members)))
    assert len(members) > 100 and {(max(x), min(x)) for x in got} <= true and smallest(got) == smallest(true)


def test_media_round_trip(spark, odd):
    for r in media_avi.store(odd).collect():
        data = (r["text"] or "").encode()
        assert r["payload"][: len(data)] == data and not any(r["payload"][len(data) :]) and len(r["payload"]) % 64 == 0 and r["payload"]
        assert r["clips"] == [type(r["clips"][0])(**c) for c in media_avi.clip_rows(r["media"])]
    assert media_avi.store(odd.limit(0)).isEmpty()
    frames = np.random.default_rng(0).integers(0, 256, (3, 8, 16), dtype=np.uint8)
    jpegs = media_avi.encode_frames(frames)
    assert all((media_avi._lossless(media_avi._parse(j)) == f).all() for j, f in zip(jpegs, frames, strict=True))
    cut = [np.zeros((8, 8), np.uint8)] * 5 + [np.full((8, 8), 200, np.uint8)] * 4
    assert media_avi.shots(cut) == [(0, 5), (5, 9)]
    with pytest.raises(ValueError):
        media_avi.read_avi(b"no file")


def test_decode_and_clips_run(spark, odd):
    made = byte_bpe.decode(byte_bpe.round_trip(odd).drop("decoded")).collect()
    assert sorted(bytes(r["decoded"]) for r in made) == sorted((r[1] or "").encode() for r in ODD)
    stored = media_avi.store(odd)
    assert media_avi.clips(stored, "doc_id").count() == sum(len(r["clips"]) for r in stored.collect())


def test_html():
    page = "<style>.x{display:none}</style><p>one<p>two &amp; three<ul><li>a<li>b</ul><div class=x>no</div><p hidden>no</p><script>no</script><table><tr><th>Name<th>Qty<tr><td>apple<td>3</table><pre>a\n  b</pre>"
    assert html_render.render(page) == "one\n\ntwo & three\n\n- a\n- b\n\nName   Qty\napple  3\n\na\n  b"
    assert html_render.render("") == "" and html_render.render("<div>" * 5000 + "x") == "x"


def test_html_shows_drawn_text_and_forms():
    show = html_render.render
    assert show("<p>a <svg><title>no</title><defs><text>no</text></defs><g><text>one</text><text>two</text></g></svg> b") == "a one two b"
    assert show("<p>x <math><mi>y</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>") == "x y=2"
    assert show("<p><textarea>typed &amp; kept</textarea>") == "typed & kept"
    assert show("<p><select><option>first<option selected>second<option>third</select>") == "second"
    assert show("<p><select><option>first<option>second</select>") == "first"
    assert show("<select multiple><option>first<option>second</select>") == "first\nsecond"


def test_licences(spark):
    files = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/f.txt", "nothing"), (3, "a/b/g.txt", "code\nLicensed under the Apache License, Version 2.0."), (4, "z/h.txt", None), (5, None, ""), (6, "a/b/COPYING", "unclear words about nothing")]
    got = {r["doc_id"]: (r["licence"], r["origin"]) for r in license_scan.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("Apache-2.0", "own"), 4: (None, "none"), 5: (None, "none"), 6: ("MIT", "inherited")}


def test_url_rules_and_ranks(spark):
    pages = [(1, "http://www.example.com/en/1", ""), (2, "http://example.com/en/2?q", ""), (3, "http://Bad.net/es/1", ""), (4, "http://friend.org/x", '<a href="http://bad.net/">'), (5, "http://far.org/", None), (6, None, ""), (7, "no url", ""), (8, "http://shop.com/a", "")]
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in url_filter.filtered(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: ("www.example.com", "www.example.com/en/", "allow"), 2: ("example.com", "example.com/en/", "block"), 3: ("bad.net", "net/es/", "block"), 4: ("friend.org", None, "block"), 5: ("far.org", None, "allow"), 6: ("", None, "allow"), 7: ("", None, "allow"), 8: ("shop.com", "com/", "allow")}


def test_crowded_hashes_come_last(spark, monkeypatch):
    """A passage that the sample of a large table doesn't show ties texts that share nothing else into no cluster; near copies among them are found as before."""
    rng = np.random.default_rng(5)
    passage = next(t for i in range(100_000) if simhash.shingles(t := f"this one passage is {i}", 5)[0] < 2**64 // 5000)
    texts = [f"{passage} {' '.join(f'w{w}' for w in rng.integers(0, 10**6, 60))}" for _ in range(45)]
    texts += [texts[7].rpartition(" ")[0] + " other"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tied, inside = [], jaccard.links_inside
    monkeypatch.setattr(jaccard, "common_hashes", lambda *_: np.zeros(0, np.uint64))
    monkeypatch.setattr(jaccard, "links_inside", lambda ties, *rest: (tied.append(ties.count()), inside(ties, *rest))[1])
    kept = sorted(r["doc_id"] for r in simhash.remove_duplicates(docs, ["doc_id", "text"]).collect())
    assert kept == list(range(45)) and tied == [0]


def test_url_walk_converges(spark):
    """A cycle, a host without out-edges and a chain longer than a few steps, against the dense solution; the chain's far end is blocked."""
    links = [("a", "b"), ("b", "a"), ("b", "c"), ("a", "dead"), *[(f"c{i}", f"c{i + 1}") for i in range(30)], ("c", "c0")]
    names = sorted({h for e in links for h in e})
    at = {h: i for i, h in enumerate(names)}
    p, seed = np.zeros((len(names), len(names))), np.zeros(len(names))
    for s, d in links:
        p[at[d], at[s]] += 1
    seed[at["a"]], seed[at["c5"]] = 0.75, 0.25
    dead = p.sum(0) == 0
    p[:, ~dead] /= p[:, ~dead].sum(0)
    p[:, dead] = seed[:, None]
    want = np.linalg.solve(np.eye(len(names)) - 0.85 * p, 0.15 * seed)
    edges = spark.createDataFrame([("w", *e, 1.0) for e in links], "walk string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("w", "a", 0.75), ("w", "c5", 0.25)], "walk string, host string, seed double")
    got = {r["host"]: r["rank"] for r in url_filter.propagate(edges, seeds).collect()}
    assert max(abs(got.get(h, 0.0) - want[at[h]]) for h in names) < 1e-6


def test_url_walk_leaves_no_files(spark, monkeypatch):
    """The shuffle files of steps go without Spark's cleaner, so that none adds up from step to step."""
    held, disk = [], spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tidy(spark)
    time.sleep(2)
    before = disk.getAllFiles().size()
    monkeypatch.setattr(url_filter, "tidy", lambda _: None)
    monkeypatch.setattr(url_filter, "tidied", lambda _: nullcontext())
    monkeypatch.setattr(url_filter, "checkpointed", lambda df: (checkpointed(df), time.sleep(0.2), held.append(disk.getAllFiles().size()))[0])
    pages = [(i, f"http://h{i % 7}.{'net/es' if i % 2 else 'com'}/", f'<a href="http://h{i % 5}.org/">') for i in range(60)]
    got = url_filter.filtered(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert max(held) <= before + 40 and got.count() == 60


def test_url_walk_of_a_small_graph_is_few_tasks(spark, monkeypatch):
    """Tasks follow the graph, not the session's partitions; a larger graph's walk, dealt over them, gives the same ranks."""
    links = [(f"h{i}", f"h{(i * k + 1) % 40}", 1.0) for i in range(40) for k in (3, 7)]
    edges = spark.createDataFrame([("w", *e) for e in links if e[0] != e[1]], "walk string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("w", "h0", 0.75), ("w", "h5", 0.25)], "walk string, host string, seed double")
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    ranks = lambda: {r["host"]: r["rank"] for r in url_filter.propagate(edges, seeds).collect()}
    names = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        context.setJobGroup("walk", "walk")
        got = ranks()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("walk") for s in tracker.getJobInfo(j).stageIds]
        assert 0 < sum(s.numCompletedTasks for s in stages if s) < 2000
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for module, name in ((skew, "SMALL"), (skew, "BROADCAST_ROWS"), (url_filter, "SMALL")):
        monkeypatch.setattr(module, name, 0)
    assert got == pytest.approx(ranks(), abs=1e-12)


def plain_ranks(edges, seeds):
    names = sorted({h for s, d, _ in edges for h in (s, d)} | set(seeds))
    at = {h: i for i, h in enumerate(names)}
    p, seed = np.zeros((len(names), len(names))), np.zeros(len(names))
    for s, d, w in edges:
        p[at[d], at[s]] += w
    for h, v in seeds.items():
        seed[at[h]] = v / sum(seeds.values())
    dead = p.sum(0) == 0
    p[:, ~dead] /= p[:, ~dead].sum(0)
    p[:, dead] = seed[:, None]
    return dict(zip(names, np.linalg.solve(np.eye(len(names)) - 0.85 * p, 0.15 * seed), strict=True)) if seeds else {}


@pytest.mark.parametrize("heavy", [500, 2])
def test_url_filter_against_plain_walk(spark, monkeypatch, heavy):
    """All verdicts of pages with cross-host links, ports, users, subdomains and odd rows against a dense walk; hubs dealt over salts too."""
    monkeypatch.setattr("auralith.skew.HEAVY", heavy)
    monkeypatch.setattr("auralith.skew.SMALL", 0)
    monkeypatch.setattr("auralith.llm.url_filter.HEAVY", heavy)
    rng, pages = np.random.default_rng(4), []
    hosts = [f"{a}h{i}.{t}" for i in range(12) for a in ("", "www.") for t in ("org", "net", "com")]
    for i in range(150):
        h = hosts[int(rng.integers(len(hosts)))]
        to = "".join(f'<a href="//{hosts[int(k)]}{":8080" if k % 3 == 0 else ""}/x">' for k in rng.integers(0, len(hosts), rng.integers(0, 4)))
        pages.append((i, f"http://{h}{':81' if i % 9 == 0 else ''}{('/es/', '/fr/', '/en/', '/')[i % 4]}{i}", to))
    pages += [(900, None, "x"), (901, "no url", None), (901, "no url", None), (902, "ftp://user@h1.org:21/a", ""), (903, "http://127.0.0.1/x", ""), (904, "http://H1.ORG/X?y", None)]
    node = lambda h: re.sub(r"^[^@]*@|:\d*$", "", h)
    edges, counts, seen = Counter(), {"allow": Counter(), "block": Counter()}, set()
    judged = []
    for i, u, html in pages:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match("[^/?#]*", rest)[0].lower()
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        rule = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        judged.append((i, host, rule))
        if host:
            seen.add(node(host))
            if rule:
                counts[rule[0]][node(host)] += 1
            for to in re.findall(r"href=\"//([^/\"]+)", html or ""):
                if node(to) != node(host):
                    edges[node(host), node(to)] += 1
                seen.add(node(to))
    done = set()
    for h in list(seen):
        while h.count(".") > 1 and not re.fullmatch(r"[0-9.]*", h):
            up = h.split(".", 1)[1]
            if (h, up) not in done:
                edges[h, up] += 1
                edges[up, h] += 1
                done.add((h, up))
            seen.add(up)
            h = up
    flat = [(s, d, w) for (s, d), w in edges.items() if w]
    seeds = {k: {h: float(np.log1p(n)) for h, n in c.items()} for k, c in counts.items()}
    trust, distrust = plain_ranks(flat, seeds["allow"]), plain_ranks([(d, s, w) for s, d, w in flat], seeds["block"])
    got = Counter((r["page_id"], r["host"], r["verdict"]) for r in url_filter.filtered(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("trust", F.lit(1))).collect())
    want = Counter()
    for i, host, rule in judged:
        d, t = distrust.get(node(host), 0.0), trust.get(node(host), 0.0)
        assert rule or not d or abs(d - t) > 1e-6
        want[i, host, rule[0] if rule else "block" if d > 0 and d * len(seen) >= url_filter.FLOOR and d >= t else "allow"] += 1
    assert got == want and {v for _, _, v in want} == {"allow", "block"}
    assert url_filter.filtered(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()


def held_out(column, of, rest):
    rows = duckdb.sql(f"SELECT doc_id, text, {column} FROM '/root/testdata/sf0.1/documents.parquet' JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    out = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % of == rest]
    return [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % of != rest][:2000], out


def test_fallback_dictionary_is_from_all_over():
    texts = ["same start " * 300 + f"mark{i} " * 100 for i in range(40)]
    made = quality_zstd.train_dictionary(texts)
    assert len(made) <= quality_zstd.DICTIONARY and all(f"mark{i} ".encode() in made for i in range(40))


def test_quality_classifier_held_out():
    train, test = held_out("quality", 5, 0)
    p = quality_zstd.scores([t for t, _ in test], quality_zstd.train(train)) >= 0.3
    assert (p == np.array([y for _, y in test])).mean() > 0.95


def test_toxicity_held_out_and_grammar():
    train, test = held_out("toxic", 4, 2)
    p = toxicity.scores([t for t, _ in test], toxicity.train(train)) >= toxicity.THRESHOLD
    assert (p == np.array([y for _, y in test])).mean() > 0.93
    one = lambda t: sum(toxicity.clause_scores(t, ()))
    assert one("you are an idiot") > one("an idiot came") > one("not an idiot") > 0 and one("he said idiot") < one("idiot")
    assert one("I will kill you") > one("to kill time") == 0 and toxicity.clause_scores("", ()) == []


def test_classifiers_on_odd_rows(spark, odd, labels):
    for run in (toxicity.scored_documents, quality_zstd.scored_documents):
        out = run(odd, labels).collect()
        assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out) and run(odd, labels.limit(0)).count() == len(ODD) and run(odd.limit(0), labels).isEmpty()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {r["doc_id"] for r in rules_mcd.quality_rules(docs).where("kept").collect()}
    stage = corpus_pipeline.quality(spark, docs, DATA)
    assert stage.columns == corpus_pipeline.COLUMNS and {r["doc_id"] for r in stage.select("doc_id").collect()} == kept
    out = corpus_pipeline.run(spark, DATA).collect()
    assert out and {r["doc_id"] for r in out} <= kept
    assert set(queries.QUERIES) >= {"op1_toxicity", "op10_quality_rules"}
