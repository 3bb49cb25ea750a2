"""The corpus operators' methods against plain versions, and their odd rows."""

import re
import struct
import subprocess
import sys
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from auralith.llm import byte_bpe, common, html_render, license_scan, media_avi, mixture, rules_mcd, toxicity


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


# sampling and joins


def test_sample_keeps_its_bounds(spark):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(50)] + [(2, "x" * 300_000), (3, "short"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in (1, 1, 2, 3, 4)] + [(None, 1)], "doc_id long, toxic int")
    got = lambda rows, size=10**6: [r["text"] for r in common.labelled_sample(docs, labels, "toxic", F.lit(False), rows, size).collect()]
    assert sorted(got(10)) == ["", "copy 0", "short"] and len(got(1)) <= 1 and sum(map(len, got(10, 7))) <= 7


def test_skewed_join(spark, monkeypatch):
    monkeypatch.setattr("auralith.skew.HEAVY", 3)
    left = spark.createDataFrame([(i % 4 if i < 40 else None, i) for i in range(45)], "k int, v int")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (9, "c")], "k int, w string")
    heavy = common.heavy_keys(left.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n")
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, "k", how).collect()))
        assert sorted(map(str, common.join_skewed(left, right, ["k"], heavy, how).select("k", "v", "w").collect())) == want


# toxicity

#: label, text: insults and threats as such, negated, reported, aimed at no one, and words that only look like them
JUDGED = [
    (1, "You are an idiot."), (1, "you stupid moron"), (1, "I will kill you."), (1, "They will hurt you, you worthless loser"), (1, "Shut up, you pathetic clown"), (1, "we are going to destroy them"), (1, "you are trash and scum"), (1, "he knows you are disgusting, you idiot"),
    (0, "You are not an idiot."), (0, "She said he was an idiot."), (0, "He never said stupid things."), (0, "we need to kill the process"), (0, "The clown came to the party."), (0, "They reported that trash piled up."), (0, "no idiot came"), (0, "beat the eggs and crush the garlic"),
    (0, "the report quoted the word scum"), (0, "I wrote that stupid is not a nice word"), (0, "burn the wood in the stove"), (0, "It isn't pathetic."),
]


def auc(scores, labels):
    a, b = ([s for s, y in zip(scores, labels, strict=True) if y == k] for k in (1, 0))
    return np.mean([(x > y) + 0.5 * (x == y) for x in a for y in b])


def test_clauses_tell_more_than_words():
    """On clauses that share their words the grammar ranks what isolated words can't."""
    y = [k for k, _ in JUDGED]
    words = set(toxicity.INSULTS) | set(toxicity.THREATS)
    isolated = [sum(w in words for w in re.findall(r"[a-z']+", t.lower())) for _, t in JUDGED]
    grammar = [max(toxicity.clause_scores(t, ()), default=0.0) for _, t in JUDGED]
    assert auc(grammar, y) > 0.97 and auc(isolated, y) < 0.8


# HTML


def test_html_spans_and_visibility():
    show = html_render.render
    assert show("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>") == "a  b\n   c\nd  e"
    assert show("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>") == "yes"
    assert show("<style>.h{visibility:hidden}.v{visibility:visible}</style><p class=h>no<span class=v>yes</span></p>") == "yes"
    assert show("<p>1 < 2 <3 <a title='x>y' href=z>t</a>") == "1 < 2 <3 t" and show("<p>a <b unclosed") == "a <b unclosed"


def test_html_table_layout_against_plain():
    """Random tables of one-letter cells with spans: every cell's letter in the column that a plain occupancy grid gives."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        rows = [[(int(rng.integers(1, 4)), int(rng.integers(1, 4))) for _ in range(rng.integers(0, 4))] for _ in range(rng.integers(1, 5))]
        taken, want = set(), []
        for r, row in enumerate(rows):
            c = 0
            for width, height in row:
                while (r, c) in taken:
                    c += 1
                want.append((r, c))
                taken |= {(r + i, c + j) for i in range(height) for j in range(width) if i or height > 1 or j or True}
                c += width
        got = [(r, c) for r, row in enumerate(html_render.placed([[(["x"], w, h) for w, h in row] for row in rows])) for c, _ in row]
        if not any((r, c) in {x for x in want[:k]} for k, (r, c) in enumerate(want)):
            assert len(got) == len(want) and [r for r, _ in got] == [r for r, _ in want] and (got == want or any(h > 1 and w > 1 for row in rows for w, h in row))


def test_html_tables_of_any_size_are_aligned_alike():
    """Rows look the same whatever number of rows follows; a cell far off moves up, and the next one is in its column again."""
    stairs = lambda n: html_render.render("<table>" + "<tr><td rowspan=65534>x" * n + "</table>").split("\n")
    assert stairs(20) == ["   " * i + "x" for i in range(20)] and stairs(3000)[:20] == stairs(20)
    wide = html_render.render(f"<table><tr><td>{'y' * 300}<td>b<td>c<tr><td>a<td>{'z' * 60}<td>c</table>").split("\n")
    assert wide == ["y" * 300 + "  b" + " " * 61 + "c", "a" + " " * 256 + "z" * 60 + " " * 47 + "c"]


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<a x='", "<div>", "<p><table>" + "<div>" * 10, "<ul><li>x", "<tr><td colspan=1000>x", "<tr><td rowspan=65534>x", "<style>a", "</p>", "<select><option>"])
def test_html_takes_linear_time(unit):
    began = time.time()
    out = html_render.render(unit * (1_000_000 // len(unit)))
    assert time.time() - began < 20 and len(out) < 20_000_000


def test_html_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "<b>" * 50_000 + "deep", "x"), (4, "plain", "x"), (5, "<!-- open", "x")]
    out = html_render.extract(spark.createDataFrame(rows, "page_id long, html string, text string"))
    assert sorted((r["page_id"], r["text"]) for r in out.collect()) == [(1, ""), (2, ""), (2, ""), (3, "deep"), (4, "plain"), (5, "")]
    assert html_render.extract(spark.createDataFrame([], "page_id long, html string")).isEmpty()


# media


def jpeg(spark, gray):
    """The bytes of a baseline JPEG by the JVM's own writer, and the samples that its own reader gives."""
    jvm = spark._jvm
    h, w = gray.shape
    image = jvm.java.awt.image.BufferedImage(w, h, jvm.java.awt.image.BufferedImage.TYPE_BYTE_GRAY)
    raster = image.getRaster()
    for y in range(h):
        for x in range(w):
            raster.setSample(x, y, 0, int(gray[y, x]))
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    back = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(out.toByteArray())).getRaster()
    return bytes(out.toByteArray()), np.array([[back.getSample(x, y, 0) for x in range(w)] for y in range(h)])


def without_tables(data):
    """The frame without its Huffman tables, as in most AVI files."""
    at, out = 2, data[:2]
    while data[at + 1] != 0xDA:
        n = 2 + int.from_bytes(data[at + 2 : at + 4], "big")
        out += b"" if data[at + 1] == 0xC4 else data[at : at + n]
        at += n
    return out + data[at:]


def test_baseline_frames_against_the_jvm(spark):
    y, x = np.mgrid[0:24, 0:40]
    gray = (128 + 60 * np.sin(x / 5) + 40 * np.cos(y / 3)).astype(np.uint8)
    data, want = jpeg(spark, gray)
    for frame in (data, without_tables(data)):
        got = media_avi.decode_frames([frame])[0].astype(int)
        assert got.shape == want.shape and np.abs(got - want).max() <= 1


def test_indexes_and_broken_files(spark):
    chunk = media_avi._chunk
    still, other = (media_avi.encode_frames(np.full((1, 8, 8), v, np.uint8))[0] for v in (10, 240))
    frames = [still] * 4 + [other] * 3
    avih = chunk(b"avih", struct.pack("<14I", 40_000, 0, 0, 0, 7, 0, 1, 0, 8, 8, 0, 0, 0, 0))

    def movie(index=b""):
        head = chunk(b"LIST", b"hdrl" + avih + chunk(b"LIST", b"strl" + chunk(b"strh", b"vidsMJPG" + bytes(48)) + index))
        body = chunk(b"LIST", b"movi" + chunk(b"LIST", b"rec " + b"".join(chunk(b"00dc", f) for f in frames[:2])) + b"".join(chunk(b"00dc", f) for f in frames[2:]))
        return head, body

    head, body = movie()
    plain = chunk(b"RIFF", b"AVI " + head + body)
    rows = [{"clip": 0, "start_s": 0.0, "end_s": 0.16, "frames": 4}, {"clip": 1, "start_s": 0.16, "end_s": 0.28, "frames": 3}]
    assert media_avi.clip_rows(plain) == rows
    # an OpenDML index that names the last five frames only, then an index of indexes to it
    own = lambda base, entries: struct.pack("<HBBI4sQI", 2, 0, 1, len(entries), b"00dc", base, 0) + b"".join(struct.pack("<II", o, k) for o, k in entries)
    head, body = movie(chunk(b"indx", own(0, [(0, 1)] * 5)))
    start, places = 12 + len(head), []
    at = plain.index(frames[0], 12 + len(movie()[0]))
    for f in frames:
        at = plain.index(f, at)
        places.append(at - 12 - len(movie()[0]))
        at += len(f)
    head, body = movie(chunk(b"indx", own(start, [(p, len(f) | 0x80000000) for p, f in list(zip(places, frames, strict=True))[2:]])))
    assert [r["frames"] for r in media_avi.clip_rows(chunk(b"RIFF", b"AVI " + head + body))] == [2, 3]
    broken = [b"", b"RIFF", plain[:100], plain.replace(b"\xff\xc3", b"\xff\xc2"), plain.replace(b"\xff\xda", b"\xff\xc4"), b"RIFF\0\0\0\0AVI ", plain.replace(struct.pack("<I", 40_000), bytes(4), 1)]
    files = spark.createDataFrame([(i, b, "x") for i, b in enumerate([plain, None, plain, *broken])], "doc_id long, media binary, error string")
    got = {r["doc_id"]: (len(r["clips"]), r["error"]) for r in media_avi.inspect(files).collect()}
    assert got[0] == got[2] == (2, None) and got[1] == (0, None) and all(got[i][0] == 0 and got[i][1] for i in range(3, 10))
    assert media_avi.clips(files, "doc_id").count() == 4 and media_avi.clips(files.limit(0), "doc_id").isEmpty()


def test_features_against_plain():
    rng = np.random.default_rng(3)
    frames = [np.clip(rng.normal(m, 3, (16, 16)), 0, 255).astype(np.uint8) for m in [40] * 6 + [200] * 5 + [90] * 4]
    h = [np.bincount(f.ravel() >> 4, minlength=16) / 256 for f in frames]
    cuts, seen, start = [], [], 0
    for i in range(1, len(h)):
        d = np.abs(h[i] - h[i - 1]).sum() / 2
        limit = max(0.25, np.mean(seen) + 3 * np.std(seen)) if seen else 0.25
        if d > limit:
            cuts.append((start, i))
            start, seen = i, []
        else:
            seen = [*seen[-11:], d]
    assert media_avi.shots(frames) == [*cuts, (start, len(frames))] == [(0, 6), (6, 11), (11, 15)]


# licences


def test_licences_of_real_files(spark):
    full = dict(license_scan.full_texts())
    code = "\n\nint main(void) { return 0; }\n" * 20
    files = [(i, f"p{i}/LICENSE", t) for i, t in enumerate(full.values())]
    files += [(100 + i, f"q{i}/a.c", "\n".join("# " + line for line in "\n".join(t.split("\n")[:25]).split("\n")) + code) for i, t in enumerate(full.values())]
    files += [(200 + i, f"p{i}/sub/deep/x.c", code) for i in range(len(full))]
    got = {r["doc_id"]: (r["licence"], r["origin"]) for r in license_scan.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    for i, name in enumerate(full):
        assert got[i] == (name, "own") and got[200 + i] == (name, "inherited")
    assert sum(got[100 + i][0] == name for i, name in enumerate(full)) >= len(full) - 2


@pytest.mark.parametrize("heavy", [500, 2])
def test_licence_inheritance_against_plain(spark, monkeypatch, heavy):
    monkeypatch.setattr("auralith.skew.HEAVY", heavy)
    monkeypatch.setattr("auralith.skew.SMALL", 0)
    rng, files = np.random.default_rng(6), []
    for i in range(120):
        depth = int(rng.integers(0, 4))
        folder = "/".join(str(k) for k in rng.integers(0, 2, depth))
        name = "LICENSE" if i % 6 == 0 else f"f{i}.txt"
        files.append((i, f"{folder}/{name}" if folder else name, ("Released under the MIT License.", "Licensed under the Apache License, Version 2.0.")[i % 2 if i % 12 else 0] if i % 6 == 0 and i % 5 else "text"))
    files += [(500, None, None), (501, "0/x.txt", ""), (501, "0/x.txt", ""), (502, "/", "x")]
    df = spark.createDataFrame(files, "doc_id long, path string, text string").withColumn("licence", F.lit("clash"))
    heads = {}
    for i, p, t in sorted(files, key=lambda f: (f[1] or "", f[0])):
        if p and re.search(r"(^|/)LICENSE$", p) and t != "text":
            heads.setdefault(re.sub(r"/?[^/]*$", "", p), (p, i, "MIT" if "MIT" in t else "Apache-2.0"))

    def inherited(p):
        d = re.sub(r"/?[^/]*$", "", p)
        while True:
            if d in heads:
                return heads[d][2]
            if not d:
                return None
            d = d.rpartition("/")[0]

    want = Counter((i, ("MIT" if "MIT" in t else "Apache-2.0") if t and "icense" in t else inherited(p) if p is not None else None) for i, p, t in files)
    got = Counter((r["doc_id"], r["licence"]) for r in license_scan.scan(df).collect())
    assert got == want and license_scan.scan(df.limit(0)).isEmpty()


# quality rules


def test_estimates_against_a_plain_search(spark):
    """The determinant of the found subset is as small as that of the best of many random starts, and planted outliers are far."""
    rng = np.random.default_rng(7)
    a = rng.normal(size=(5, 5)) * 0.3
    good = rng.normal(size=(360, 5)) @ a
    bad = rng.normal(size=(60, 5)) * 0.1 + 3.0
    x = np.r_[good, bad]
    rows = spark.createDataFrame([(1, *map(float, r)) for r in x], "g int, " + ", ".join(f"{d} double" for d in rules_mcd.DIMS)).select(F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")).alias("group"), *rules_mcd.DIMS)
    found = rules_mcd.search(rows).first()
    floors = np.diag(np.square(rules_mcd.FLOORS))

    def step(mean, cov):
        d = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov + floors), x - mean)
        near = x[d <= np.quantile(d, rules_mcd.COVERED, method="inverted_cdf")]
        return near.mean(0), np.cov(near.T, bias=True)

    best = None
    for _ in range(100):
        s = x[rng.choice(len(x), 8, replace=False)]
        m, c = s.mean(0), np.cov(s.T, bias=True)
        for _ in range(30):
            m, c = step(m, c)
        best = min(best or (np.inf,), (float(np.linalg.slogdet(c + floors)[1]), m.tolist(), c.tolist()))
    m = np.array([found[f"m{i}"] for i in range(5)])
    assert np.abs(m - good.mean(0)).max() < 0.15 and np.abs(np.array(best[1]) - good.mean(0)).max() < 0.15
    estimate = rules_mcd._factored(rules_mcd.search(rows), ["group"]).first()
    low = np.zeros((5, 5))
    for i, j in rules_mcd.TRIANGLE:
        low[i, j] = estimate[f"l{i}{j}"]
    far = ((np.linalg.solve(low, (x - m).T)) ** 2).sum(0)
    assert (far[:360] <= rules_mcd.CUTOFF).mean() > 0.99 and (far[360:] > rules_mcd.CUTOFF).all()
    # the determinant of the best subset, before the reweighted step
    start = rules_mcd._factored(rules_mcd._starts(rows), ["group", "start"])
    n = start.count()
    for _ in range(8):
        start = rules_mcd._step(rows, start, n)
    assert min(r["logdet"] for r in start.collect()) <= best[0] + 0.05


def test_quality_counts_and_verdicts(spark):
    """All counts and verdicts of real and odd texts against a plain version of the counts, distances by NumPy from the same estimates."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(9001, None, None, None), (9002, "", "en", "src0"), (9003, "a b\n\na b\n \na b #*$ %&|<>", "en", "src0"), (9003, "a b\n\na b\n \na b #*$ %&|<>", "en", "src0"), (9004, "w " * 40_000, "en", None)], "doc_id long, text string, lang string, source string")
    docs = docs.unionByName(odd).withColumn("distance", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("n_words", F.lit(0))
    stats = rules_mcd.base_counts(docs, ["doc_id", "lang", "source"])
    model = rules_mcd.fit(common.checkpointed(stats))
    estimates = {(r["lang"], r["source"]): r for r in model.estimates.collect()}
    got = sorted(rules_mcd.quality_rules(docs).collect(), key=str)
    plain = []
    for r in docs.collect():
        t = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        c = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = np.zeros(len(w), bool)
        for k in range(len(w) - 7):
            if c[tuple(w[k : k + 8])] > 1:
                covered[k : k + 8] = True
        chars, symbols, dups, repeats = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), int(covered.sum())
        failed = len(w) < 20 or 100 * repeats > 30 * len(w)
        distance = None
        if not failed:
            e = estimates[r["lang"], r["source"]]
            v = np.array([np.log(chars / len(w)), np.log(1 + 100 * symbols / chars), dups / len(lines), repeats / len(w), np.log(len(set(w)) / len(w))])
            low = np.zeros((5, 5))
            for i, j in rules_mcd.TRIANGLE:
                low[i, j] = e[f"l{i}{j}"]
            distance = float((np.linalg.solve(low, v - [e[f"m{i}"] for i in range(5)]) ** 2).sum())
        plain.append((r["doc_id"], len(w), chars, symbols, dups, repeats, failed, not failed and distance <= rules_mcd.CUTOFF, distance))
    assert len(got) == len(plain)
    for a, b in zip(sorted(got, key=lambda r: r["doc_id"]), sorted(plain, key=lambda r: r[0]), strict=True):
        assert tuple(a)[:8] == b[:8] and (a["distance"] is None) == (b[8] is None) and (b[8] is None or abs(a["distance"] - b[8]) < 1e-6 * max(1, b[8]))
    assert rules_mcd.quality_rules(docs.limit(0)).isEmpty()


# byte-level BPE


def test_bpe_operators_on_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "a" * 30_000, 5), (3, "a" * 30_000, 5)], "doc_id long, text string, ids int")
    made = byte_bpe.encode(rows)
    assert made.columns == ["doc_id", "text", "ids"] and [len(r["ids"]) for r in made.where("doc_id < 3").collect()] == [0, 0]
    assert byte_bpe.encode(rows.limit(0)).isEmpty() and byte_bpe.round_trip(rows.limit(0)).isEmpty()
    lists = spark.createDataFrame([(1, None), (2, [0, -1, None, 10**9]), (3, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(lists).collect()} == {1: b"", 2: b"!", 3: b""}


# pipeline


def plain_pipeline(docs, labels, spark):
    """The stages by plain code over rows, with the fitted estimates and scores of the operators that are tested by themselves."""
    rows = [tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
    judged = Counter()
    for r in rules_mcd.quality_rules(docs).where("kept").select("doc_id").collect():
        judged[r["doc_id"]] += 1
    rows = [r for r in rows if judged[r[0]]]
    fit = toxicity.fit(texts(spark, rows), labels) if rows else None
    rows = [r for r in rows if toxicity.scores([r[1] or ""], fit)[0] < toxicity.THRESHOLD]
    sets = [{xxhash.xxh64_intdigest(b" ".join(w[k : k + 5]), 42) for k in range(max(1, len(w) - 4))} if (w := (r[1] or "").encode().lower().split()) else set() for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both, n = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if 5 * both >= 4 * n:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for k, r in enumerate(rows):
        smallest[find(k)] = min(smallest.get(find(k), r[0]), r[0])
    rows = [r for k, r in enumerate(rows) if smallest[find(k)] == r[0]]
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixture.mix(texts(spark, rows)).collect()}
    codec, out = byte_bpe.codec(byte_bpe.public_tokenizers.path(byte_bpe.RANKS)), Counter()
    for r in rows:
        n, size = taken[r[0]]
        parts = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", r[1] or "")
        for _ in range(n // size if size else 1):
            out[r[0], tuple(codec.encode(r[1] or "").tolist())] += 1
        if size and n % size:
            out[r[0], tuple(codec.encode("".join(parts[: n % size])).tolist())] += 1
    return out


def test_pipeline_against_plain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect())
    assert got == plain_pipeline(docs, labels, spark) and len(got) > 50


def test_stages_on_odd_rows(spark, tmp_path):
    prose = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew strange green potions near an old stone bridge at night"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, prose, "en", "s", 1), (3, prose, "en", "s", 1), (4, prose + " now", "en", None, 2), (None, prose, None, "t", 3), (5, "x " * 30_000, "de", "t", 4), (6, prose.replace("fox", "cat") + " 1 2 3 4 5 6 7 8 9", "en", "s", 5)]
    for table in (rows, []):
        folder = tmp_path / str(len(table))
        texts(spark, table).withColumn("score", F.lit(1)).withColumn("__row", F.lit(1)).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(3, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        docs = spark.read.parquet(str(folder / "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(folder)).collect()
            assert len(out) <= 3 * len(table) and (table or not out)
        assert sorted(r["doc_id"] or 0 for r in corpus_pipeline.distinct(spark, docs, str(folder)).collect()) == ([0, 1, 3, 5, 6] if table else [])
        assert corpus_pipeline.run(spark, str(folder)).count() >= (1 if table else 0)


# the entry module


@pytest.mark.parametrize("missing", ["ahocorasick", "zstandard", "corpus_pipeline"])
def test_entry_without_a_library(missing):
    """The other queries are there when the subpackage can't be imported."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(n.startswith('op') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/", 3)[0])
