"""Operators against brute force on small frames with nulls, empty and repeated rows."""

import hashlib
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyline.llm import bpe, chunking, common, components, knn, licenses, line_dedup, media, mixing, ngram_join, quality, toxicity

WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n=60):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.fixture(scope="module")
def docs(spark):
    near = prose(1).split()
    near[59] = "edited"
    rows = [(1, prose(1)), (2, " ".join(near)), (3, prose(3)), (4, None), (5, ""), (6, prose(1)), (7, " \n "), (8, prose(8, 3000)), (9, "a b"), (None, prose(9)), (3, prose(3))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.withColumns({"source": F.when(F.col("doc_id") % 2 == 0, "a"), "size": F.lit(1), "n": F.lit("x")})


def test_bpe_equals_tiktoken(spark, docs):
    import tiktoken

    vocabulary = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(vocabulary)}, special_tokens={})
    odd = spark.createDataFrame([(20, "aaaaaaa" * 300), (21, "日本語 ÄÖ\x1c x  \n\n it's 12345")], "doc_id long, text string")
    got = bpe.encode(docs.select("doc_id", "text").unionByName(odd).where("doc_id is not null").distinct(), "doc_id", "text", vocabulary, public_tokenizers.PATTERN, back=True).collect()
    texts = dict((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").unionByName(odd).collect())
    assert len(got) == 11
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == own.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()


def test_media_round_trip(spark, docs):
    for raw in (b"", b"x" * 576, b"y" * 577):
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert media.from_png(media.to_png(payload)).tobytes() == payload
    raw = docs.select(media.padded(F.col("text").cast("binary")).alias("p"))
    for r in media.describe(media.media_table(raw, "p")).collect():
        assert r["digest"] == r["payload_sha256"] and r["payload_bytes"] % 576 == 0
    html = spark.createDataFrame([(1, "<p>one</p><figure><img src='a.png' alt='x'><figcaption>cap</figcaption></figure>two"), (2, None)], "k long, html string")
    first = media.sequences(html, "k", "html").where("k = 1").first()["segments"]
    assert [(s["pos"], s["kind"], s["caption"]) for s in first] == [(0, "text", None), (1, "media", "cap"), (2, "text", None)]
    assert first[1]["digest"] == hashlib.sha256(b"a.png").hexdigest() and zlib.crc32(b"") == 0


def test_mixing(docs):
    assert mixing.targets([100, 100, 0]) == [200.0, 100.0, 0.0]
    index = np.arange(1000)
    assert sorted(mixing.permuted(index, np.full(1000, 1000), np.full(1000, 5)).tolist()) == index.tolist()
    rows = mixing.mix(docs, block=16, shards=4).collect()
    assert len(rows) == 11 and all(r["taken"] <= 2 * r["size"] for r in rows)
    assert rows == mixing.mix(docs, block=16, shards=4).collect() or sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs, block=16, shards=4).collect()))
    out = mixing.materialise(docs, block=16, shards=4)
    assert out.columns == docs.columns
    assert out.agg(F.sum(mixing.words(F.col("text")))).first()[0] == sum(r["taken"] for r in rows)


def test_ngram_join(docs):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs, size=3, percent=90).collect()}
    assert found[1] == (58, 1) and found[2][1] == 1 and found[6] == (58, 1)
    assert found[3][1] == 3 and found[4] == (0, 4) and found[5] == (0, 5) and found[9] == (1, 9) and found[None][1] is None


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 40)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert {found[i] for i in range(1, 31)} == {1} and found[50] == found[40] == 40 and len(found) == 32
    assert components.components(edges.limit(0)).count() == 0


def test_line_dedup(spark):
    base = prose(11, 40)
    near = base.replace("w", "v", 1)
    frame = spark.createDataFrame([(1, f"{base}\nonly here one\n\nshort"), (2, f"{near}\nshort\n\nanother line that stays"), (3, None), (4, "short")], "doc_id long, text string")
    found = {r["doc_id"]: r["removed"] for r in line_dedup.report(frame).collect()}
    assert found == {1: [], 2: [0, 1], 3: [], 4: [0]}
    assert {r["doc_id"]: r["text"] for r in line_dedup.apply(frame).collect()} == {1: f"{base}\nonly here one\n\nshort", 2: "\nanother line that stays", 3: None}


def test_chunks_resist_insertions(docs, spark):
    data = prose(21, 800).encode()
    moved = set(np.asarray(chunking.ends(b"inserted " + data)) - 9) & set(chunking.ends(data).tolist())
    assert len(moved) > 0.95 * len(chunking.ends(data))
    passage = prose(22, 60)
    frame = spark.createDataFrame([(1, prose(23) + " " + passage), (2, prose(24) + " " + passage + " " + prose(25)), (3, prose(26)), (4, None)], "doc_id long, text string")
    rows = chunking.passages(frame, "doc_id", "text").collect()
    assert [(r["doc_id"], r["keep_doc_ids"]) for r in rows] == [(2, [1])]


def test_licenses(spark):
    mit = "\n".join(licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "mit-asis", "mit-liability"))
    frame = spark.createDataFrame([(1, mit.replace("free of charge, ", "free of charge,\n")), (2, "Text.\nReleased under the MIT License.\nMore"), (3, "mit license"), (4, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["licence"], r["kind"]) for r in licenses.scan(frame, "doc_id", "text").collect()) == [(1, "MIT", "text"), (2, "MIT", "reference")]


def test_knn(spark):
    random = np.random.default_rng(3)
    vectors = {i: random.normal(size=6).astype(np.float32) for i in range(300)} | {300: np.zeros(6, np.float32), 301: np.zeros(6, np.float32)}
    rows = [(i, v.tolist()) for i, v in vectors.items()] + [(400, None), (401, [float("nan")] * 6), (402, [1.0]), (None, [0.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in knn.join(frame, "vec_id", "embedding", F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    scaled = {i: np.floor(1024 * v.astype(np.float64)).astype(int) for i, v in vectors.items()}
    for q in (0, 100, 200, 300):
        best = sorted(((-int(scaled[q] @ v), i) for i, v in scaled.items() if i != q))[:10]
        assert got[q] == [(i, -s) for s, i in best]
    assert set(got) == {0, 100, 200, 300}


def test_classifiers(spark):
    rows = [(i, int(i % 4 == 0), (prose(i) + (" vile " * 3 + prose(i + 999, 5) if i % 4 == 0 else ""))) for i in range(240)]
    sample = spark.createDataFrame(rows, "doc_id long, label int, text string")
    model = toxicity.train(sample)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(sample, "doc_id", "text", model).collect()}
    assert min(scored[i] for i in range(0, 240, 4)) > max(scored[i] for i in range(1, 240, 4))
    weights = quality.train(sample)
    scored = {r["doc_id"]: r["score"] for r in quality.score(sample, "doc_id", "text", weights).collect()}
    assert np.mean([scored[i] for i in range(0, 240, 4)]) > np.mean([scored[i] for i in range(1, 240, 4)])
    scores = np.array([1.0, -2, 3, -1, 2, -9, 1])
    assert toxicity.segments(scores) == [(0, 1, 1.0), (2, 5, 4.0), (6, 7, 1.0)]


@pytest.mark.parametrize("crowded", [0, 32])
def test_line_dedup_verifies_every_candidate(spark, monkeypatch, crowded):
    """Chains of edits, crowded groups forced: no similar pair that shares a bucket may end in two components, nor others in one."""
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    random, rows = np.random.default_rng(5), []
    for family in range(12):
        line = list(prose(500 + family, 30))
        for _ in range(16):
            rows.append("".join(line))
            at = random.integers(len(line))
            line[at] = "#" if line[at] != "#" else "+"
    found = line_dedup.lines(spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "doc_id long, text string"), "doc_id", "text")
    entries = line_dedup.buckets(line_dedup.signatures(found)).collect()
    texts = {r["id"]: r["line"] for r in found.collect()}
    sets = {i: {x[k : k + 8] for k in range(len(x) - 7)} for i, x in texts.items()}
    members = {}
    for r in entries:
        members.setdefault(r["bucket"], set()).add(r["id"])
    similar = {(a, b) for m in members.values() for a in m for b in m if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    every = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    widest = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(every, "a long, b long")).collect()}
    root = {r["id"]: r["component"] for r in line_dedup.classes(found).collect()}
    assert [p for p in similar if root.get(p[0], p[0]) != root.get(p[1], p[1])] == []
    assert [i for i, component in root.items() if widest.get(i, i) != widest.get(component, component)] == []


def test_licenses_keeps_matches_of_wrapped_lines_elsewhere(spark):
    line, broken = "Released under the MIT License.", "Released under\nthe MIT License."
    apache = [licenses.SENTENCES[k][0] for k in ("apache2-head", "apache2-copy", "apache2-asis", "apache2-see")]
    notice = "\n".join([apache[0], apache[1] + ".", apache[2].replace("law or agreed", "law or\nagreed"), apache[3]])
    rows = [(1, f"Text.\n{line}\nMore text.\n{broken}\n"), (2, f"Text.\n{line}\nMore.\n"), (3, notice), (4, f"-----\n{line}\n")]
    got = sorted(tuple(r) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect())
    assert got == [
        (1, "MIT", "reference", False, 1, 1), (1, "MIT", "reference", True, 3, 3), (2, "MIT", "reference", False, 1, 1),
        (3, "Apache-2.0", "notice", False, 0, 1), (3, "Apache-2.0", "notice", True, 0, 3), (4, "MIT", "reference", False, 1, 1),
    ]


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    near = prose(31).split()
    near[59] = "edited"
    rows = [(2, prose(31), "a"), (5, " ".join(near), "a"), (5, prose(32), "a"), (None, prose(33), "a"), (None, prose(34), None), (None, prose(31), "b"), (7, prose(35), "a"), (7, prose(35), "a"), (None, None, "a"), (8, "", "a"), (8, "", "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in corpus_pipeline.dedup_documents(spark, frame, "").collect()]
    assert sorted(got, key=str) == sorted([rows[i] for i in (0, 2, 3, 4, 6, 8, 9, 10)], key=str)


def test_media_captions_keep_their_text():
    def found(html):
        return [(s["pos"], s["kind"], s["text"], s["caption"]) for s in media._Segments().segments(html)]

    assert found("<figure><pre>code</pre><figcaption>cap</figcaption></figure>x") == [(0, "text", "code", None), (1, "text", "cap", None), (2, "text", "x", None)]
    assert found("<figcaption>alone</figcaption>x") == [(0, "text", "alone", None), (1, "text", "x", None)]
    assert found("<figure><img src='a'><figcaption>open</figure>after") == [(0, "media", "a", "open"), (1, "text", "after", None)]
    assert found("<figure><figcaption>first</figcaption><img src='a' alt='x'><figcaption>last</figcaption></figure>") == [(0, "media", "a", "first last")]
    assert found("<figcaption>never closed <b>to the end") == [(0, "text", "never closed to the end", None)]


def test_line_dedup_tells_rows_of_one_key_apart(spark):
    """Clashing column names, null and repeated keys, repeated rows, blank and empty texts."""
    same = prose(41, 30)
    rows = [(1, same, "a"), (2, f"{same}\nown line of two", "b"), (2, f"other first line\n{same}", "c"), (None, same, "d"), (1, same, "e"), (3, None, "f"), (4, "", "g"), (5, " \n ", "h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, dedup_key string").withColumns({c: F.lit(0) for c in ("dedup_lines", "lines", "row", "key", "number", "id", "doc")})
    got = sorted(((r["dedup_key"], r["text"]) for r in line_dedup.apply(frame).collect()))
    # the line stays where its key is least: null keys come first
    assert got == [("b", "own line of two"), ("c", "other first line"), ("d", same), ("f", None), ("g", ""), ("h", " \n ")]
    assert line_dedup.apply(frame).columns == frame.columns
    assert line_dedup.report(frame.limit(0)).count() == 0 and line_dedup.apply(frame.limit(0)).count() == 0
    assert sorted((r["doc_id"] or 0, r["n_lines"], r["removed"]) for r in line_dedup.report(frame).collect()) == [(0, 1, []), (1, 1, [0]), (1, 1, [0]), (2, 2, [0]), (2, 2, [1]), (3, 0, []), (4, 1, []), (5, 2, [])]


def test_line_dedup_recall_on_chains(spark):
    """Families of lines, each an edit of the one before: components against all pairs."""
    random, rows = np.random.default_rng(8), []
    for family in range(30):
        line = list(prose(700 + family, 40))
        for _ in range(11):
            rows.append("".join(line))
            for at in random.integers(len(line), size=2):
                line[at] = "#" if line[at] != "#" else "+"
    sets = [{x[k : k + 8] for k in range(len(x) - 7)} for x in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    wanted = sum(r != i for i, r in enumerate(root))
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "doc_id long, text string")
    found = sum(r["n_removed"] for r in line_dedup.report(frame).collect())
    assert 0.95 * wanted <= found <= wanted


def test_segments_equal_brute_force():
    """The best segment by all pairs of ends, then the same left and right of it."""

    def every(scores, at=0):
        sums = np.concatenate([[0.0], np.cumsum(scores)])
        best = max(((sums[j] - sums[i], i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        value, i, j = best
        return every(scores[:i], at) + [(at + i, at + j, value)] + every(scores[j:], at + j)

    random = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 30, 60):
        for _ in range(8):
            scores = random.normal(-0.2, 1, n)
            got, wanted = toxicity.segments(scores), every(scores)
            assert [x[:2] for x in got] == [x[:2] for x in wanted] and np.allclose([x[2] for x in got], [x[2] for x in wanted])


def test_toxicity_keep_and_odd_rows(spark):
    rows = [(i, int(i % 4 == 0), prose(i) + (" vile " * 3 if i % 4 == 0 else "")) for i in range(200)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, label int, text string"))
    odd = [(1, None, 1), (1, "", 2), (None, prose(1), 3), (1, prose(1), 4), (1, prose(1), 4), (2, "vile vile vile", 5), (3, prose(5, 150_000), 6)]
    frame = spark.createDataFrame(odd, "doc_id long, text string, score int")
    assert sorted(r["score"] for r in toxicity.keep(frame, "text", model, 0.7).collect()) == [1, 2, 3, 4, 4, 6]
    scored = toxicity.score(frame, "doc_id", "text", model).collect()
    assert len(scored) == 7 and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.keep(frame.limit(0), "text", model, 0.7).count() == 0
    nothing = toxicity.train(spark.createDataFrame([], "doc_id long, label int, text string"))
    assert toxicity.score(frame, "doc_id", "text", nothing).count() == 7


def test_mixing_keeps_other_columns_and_repeated_keys(spark):
    rows = [(1, prose(1, 40), "a", 1), (1, prose(2, 40), "a", 2), (1, prose(2, 40), "a", 2), (None, prose(3, 40), None, 3), (None, prose(4, 40), None, 4), (5, None, "a", 5), (6, "", "b", 6)]
    names = ("row", "blocks", "mix_size", "mix_turn", "mix_copy", "size", "copy", "spread")
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, mark int").withColumns({c: F.col("mark") for c in names})
    out = mixing.materialise(frame, block=8, shards=2)
    got = out.collect()
    assert out.columns == frame.columns and got and all(r[c] == r["mark"] for r in got for c in names)
    assert {r["mark"] for r in got} <= {1, 2, 3, 4}
    whole = {m: set(t.split()) for _, t, _, m in rows if t}
    assert all(set(r["text"].split()) <= whole[r["mark"]] for r in got)
    mixed = mixing.mix(frame, block=8, shards=2).collect()
    assert len(mixed) == 7 and sum(r["taken"] for r in mixed) == sum(len(r["text"].split()) for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.materialise(frame, block=8, shards=2).collect()))
    assert mixing.materialise(frame.limit(0)).count() == 0


def test_licenses_tell_versions_apart(spark):
    line = "This Source Code Form is subject to the terms of the Mozilla Public License, v. {}."
    rows = [(1, line.format("2.0")), (2, line.format("1.1")), (3, "Text. " + line.format("2.0") + " More text.")]
    got = sorted((r["doc_id"], r["licence"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect())
    assert got == [(1, "MPL-2.0"), (3, "MPL-2.0")]


def test_labelled_rows_are_the_same_each_time(spark):
    from tallyline.llm.training import labelled

    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, quality int")
    got = labelled(docs, labels, "doc_id", "text", "quality", 10, F.lit(True)).collect()
    assert sorted((r["doc_id"], r["label"], r["text"]) for r in got) == [(1, 1, "a"), (2, 0, "")]


def _held(spark):
    """Files of data below the checkpoint folder, and bytes in them."""
    folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    root = Path(folder.get().removeprefix("file:")) if folder.isDefined() else None
    return {p: p.stat().st_size for p in root.rglob("part-*")} if root else {}


def test_line_dedup_keeps_no_intermediate_files(spark):
    base = prose(1, 300)
    rows = [(i, f"{base} {'x' * (i % 50)}\n{prose(100 + i, 40)}") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    before = _held(spark)
    got = line_dedup.removed(frame, "doc_id", "text")
    new = {p: n for p, n in _held(spark).items() if p not in before}
    assert len({p.parent for p in new}) == 1  # that of the result
    assert got.count() == 59


def test_filter_loses_nothing_and_grows_with_what_is_wanted(spark, monkeypatch):
    found = spark.range(40_000).select(F.xxhash64("id").alias("h"), "id")
    wanted = found.where("id < 8000").select("h")
    monkeypatch.setattr(common, "FILTER_BITS", 10)
    passed = [r["id"] for r in common.maybe(found, wanted, "h", 8000).collect()]
    assert set(range(8000)) <= set(passed) and len(passed) < 14_000  # a filter of 10 bits would let all through


def test_settled_frames_outlive_what_they_were_made_of(spark):
    def build():
        return common.cut(spark.range(10), packed=True).join(common.cut(spark.range(5, 20)), "id")

    for packed in (False, True):
        before = set(_held(spark))
        out = common.settled(build, packed)
        assert sorted(r["id"] for r in out.collect()) == [5, 6, 7, 8, 9]
        assert len({p.parent for p in set(_held(spark)) - before}) == 1
        common.drop(out)
        assert not set(_held(spark)) - before


def test_components_local_and_distributed_agree(spark, monkeypatch):
    random = np.random.default_rng(5)
    rows = [(int(a), int(b)) for a, b in random.integers(-200, 200, (230, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(None, 5), (7, 7)]
    frame = spark.createDataFrame(rows, "a long, b long")
    near = {r["node"]: r["component"] for r in components.components(frame).collect()}
    monkeypatch.setattr(components, "LOCAL", -1)
    assert near == {r["node"]: r["component"] for r in components.components(frame).collect()}
    assert near[1100] == 1000 and components.components(frame.limit(0)).count() == 0
    monkeypatch.setattr(components, "LOCAL", 10)
    assert components.components(frame.limit(0)).count() == 0


def test_ngram_join_keeps_no_intermediate_files(spark, docs):
    before = set(_held(spark))
    got = ngram_join.join(docs.where("doc_id is not null"), "doc_id", "text")
    assert len({p.parent for p in set(_held(spark)) - before}) == 1
    assert got.count() == 10


def test_line_dedup_report_shuffles_no_text(spark):
    texts = ["", "\n", "a\n\nb", "é\nü", None, "one line"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = line_dedup.report(frame)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan and "text" not in plan.partition("LeftOuter")[0]
    assert [r["n_lines"] for r in found.orderBy("doc_id").collect()] == [1, 2, 3, 2, 0, 1]


def test_line_dedup_reads_lines_twice(spark, monkeypatch):
    frame = spark.createDataFrame([(1, "the same long line in two documents\nalone"), (2, "the same long line in two documents\nthe same long line in two documentz")], "doc_id long, text string")
    whole, read = line_dedup.cut, []
    monkeypatch.setattr(line_dedup, "cut", lambda df, *a, **b: read.append(df._jdf.queryExecution().optimizedPlan().toString().count("posexplode")) or whole(df, *a, **b))
    assert {r["doc_id"]: r["removed"] for r in line_dedup.report(frame, percent=70).collect()} == {1: [], 2: [0, 1]}
    assert sum(map(bool, read)) == 2


def test_lean_stages_relieve_the_driver(spark, monkeypatch):
    """Garbage of the driver's JVM goes with ``cut`` in ``lean``, seldom enough; stages of the pipeline are lean."""
    import corpus_pipeline

    assert common._trim(spark)
    done, real = [], common.relieve
    monkeypatch.setattr(common, "relieve", lambda session: done.append(real(session)))
    common.cut(spark.range(3))
    assert not done
    with common.lean(spark):
        garbage = spark._jvm.java.lang.ref.WeakReference("a text that only the JVM holds")
        common.cut(spark.range(3))
        assert garbage.get() is None and len(done) == 2
        monkeypatch.setattr(common, "RELIEF", 1e-9)  # of what follows
        common._lean.get()[0] = 0.0
        for _ in range(3):
            common.cut(spark.range(3))
        assert len(done) == 3
    assert len(done) == 4
    docs = spark.createDataFrame([(1, prose(1), "a"), (2, prose(2), "b")], "doc_id long, text string, source string")
    for stage in (corpus_pipeline.dedup_lines, corpus_pipeline.dedup_documents, corpus_pipeline.mix_sources):
        done.clear()
        assert stage(spark, docs, "").count() >= 2 and len(done) >= 3


def _bytes_written(spark, build):
    """Bytes that Hadoop's file systems wrote while ``build`` ran, and those of the new files that are left."""
    written = lambda: sum(s.getBytesWritten() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before, old = written(), _held(spark)
    build()
    return written() - before, sum(n for p, n in _held(spark).items() if p not in old)


def test_ngram_join_writes_files_for_its_result_only(spark):
    rows = [(i, prose(i // 3, 200) + " end" * (i % 3)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    written, left = _bytes_written(spark, lambda: ngram_join.join(frame))
    assert 0 < left <= written < 1.5 * left


def test_blocks_that_are_lost_are_made_anew(spark):
    runs = []

    def build():
        runs.append(common._safe.get())
        inner = common.settled(lambda: common.cut(spark.range(7), packed=True).select((F.col("id") * 2).alias("id")))
        if len(runs) == 1:
            inner._cut.unpersist(True)  # as if the executor were gone
        return inner.join(common.cut(spark.range(5, 20)), "id")

    before = set(_held(spark))
    out = common.settled(build)
    assert sorted(r["id"] for r in out.collect()) == [6, 8, 10, 12] and runs == [False, True]
    common.drop(out)
    assert not set(_held(spark)) - before and not len(spark.sparkContext._jsc.sc().getRDDStorageInfo()) and not common._safe.get()


def test_line_dedup_writes_files_for_its_result_only(spark):
    rows = [(i, f"{prose(i // 3, 200)}{' end' * (i % 3)}\n{prose(1000 + i, 40)}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    written, left = _bytes_written(spark, lambda: line_dedup.removed(frame, "doc_id", "text"))
    assert 0 < left <= written < 1.5 * left
