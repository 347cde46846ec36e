"""Every dealt operator against brute force on small fixtures with nulls, empty and long texts, ties and repeats."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritally.llm import (
    exact_dedup,
    html_extraction,
    jaccard_join,
    language_id,
    license_scan,
    mixing,
    packing,
    suffix_dedup,
    token_counts,
    topk_search,
)
from veritally.llm.common import Scratch
from veritally.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ("_text", "_size", "_hash", "n", "key", "rep", "bucket", "size", "taken", "letters", "carry", "a", "b")
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHING)


def words(seed, count, vocabulary=400):
    rng = np.random.default_rng(seed)
    return [f"w{k}" for k in rng.integers(0, vocabulary, count)]


def fixture_rows():
    base, other, passage = words(1, 120), words(2, 300), words(3, 60)
    near = list(base)
    near[50] = "changed"
    far = [w if i % 6 else f"x{i}" for i, w in enumerate(base)]
    texts = [
        None, "", " \n\t", "One", "one", "ONE two", "É é", " ".join(base), " ".join(base).upper(), " ".join(near),
        " ".join(far), " ".join(other), " ".join(other[:100] + passage + other[100:]), " ".join(words(4, 90) + passage),
        "\n".join(words(5, 30)) + "\n" + " ".join(passage), "tick " * 3000, "12 34 --", "你好 世界 再见 朋友 们", None,
        "Licensed under the Apache License, Version 2.0.\n" + " ".join(words(6, 40)), " ".join(words(7, 20_000, 9000)),
        "a b c d e f", "a b c d e f g", "A b c d e f",
    ]
    rows = [(i, t, "de" if i % 2 else "en", ("s1", "s2", None, "S")[i % 4]) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, "one", None, "s1"), (40, "cut", None, "tiny")]
    return [r + ("clash",) * len(CLASHING) for r in rows]


ROWS = fixture_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def scratch(spark):
    with Scratch(spark, "tests") as made:
        yield made


def normal(text):
    return (text or "").translate(ASCII)


def split(text):
    return WORDS.findall(normal(text))


# ---- exact dedup ----


def test_exact_duplicates(docs, nothing, rows):
    groups = defaultdict(list)
    for r in ROWS:
        groups[normal(r[1])].append(r[0])
    expected = []
    for r in ROWS:
        ids = groups[normal(r[1])]
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(normal(r[1]).encode()).hexdigest()
        expected.append((r[0], keep, len(ids), r[0] == keep, digest))
    found = exact_dedup.exact_duplicates(docs, digest="text_sha256")
    assert rows(found) == sorted(expected, key=repr)
    # Without the digest, with tiny bitmaps, where chance hits abound, the groups are the same.
    plain = exact_dedup.exact_duplicates(docs, prefix_chars=1, bits=32768)
    assert rows(plain) == sorted((e[:4] for e in expected), key=repr)
    assert exact_dedup.exact_duplicates(nothing).count() == 0


# ---- n-gram Jaccard join ----


def shingles(text):
    w = split(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_jaccard_components(docs, nothing, scratch, rows):
    root = brute_components(ROWS)
    expected = [(r[0], len(shingles(r[1])), root.get(r[0])) for r in ROWS]
    assert rows(jaccard_join.jaccard_components(docs, scratch)) == sorted(expected, key=repr)
    assert jaccard_join.jaccard_components(nothing, scratch).count() == 0


def test_jaccard_chains_and_passages(spark, scratch):
    """Chains of edits, where only neighbours link, and one passage in many texts, which link with none."""
    base, passage, made = words(20, 80, 5000), words(21, 40, 5000), []
    for k in range(60):
        text = list(base)
        for j in range(k):
            text[j] = f"edit{j}"
        made.append((k, " ".join(text)))
    made += [(100 + k, " ".join(words(100 + k, 60, 5000) + passage)) for k in range(80)]
    found = jaccard_join.jaccard_components(spark.createDataFrame(made, "doc_id long, text string"), scratch)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute_components(made)


def shingle_keys(text):
    import pyarrow as pa

    data, bounds = jaccard_join.text_buffer(pa.array([text]))
    return next(jaccard_join.shingle_sets(data, bounds, 0, 1, np.zeros(1 << jaccard_join.CELL_BITS, np.uint8), 5))


def test_links_of_members_that_do_not_stand_for_their_group(spark, scratch, monkeypatch):
    """Only the second member of a group with one prefix links to a document of another component."""
    for seed in range(5000):
        first = words(seed, 104, 5000)
        if set(shingle_keys(" ".join(first))[:26]) <= set(shingle_keys(" ".join(first[:90]))):
            break
    prefix = shingle_keys(" ".join(first))[:26]
    for seed in range(5000, 10_000):
        second = first[:90] + words(seed, 14, 5000)
        if (shingle_keys(" ".join(second))[:26] == prefix).all():
            break
    other = words(10_000, 14, 5000) + second[14:]
    made = [(1, " ".join(first)), (2, " ".join(second)), (3, " ".join(other))]
    assert brute_components(made) == {1: 1, 2: 1, 3: 1} and brute_components([made[0], made[2]]) == {1: 1, 3: 3}
    star = spark.createDataFrame([(1, 2)], "a long, b long")
    monkeypatch.setattr(jaccard_join, "star_pairs", lambda reps, percent: star)
    found = jaccard_join.jaccard_components(spark.createDataFrame(made, "doc_id long, text string"), scratch)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 1, 3: 1}


def test_candidates_of_long_runs():
    comp = np.array([1] * 100 + [2] * 3)
    pairs = set()
    for i, j in jaccard_join.run_pairs(comp, np.array([0]), np.array([103])):
        pairs |= {(min(x, y), max(x, y)) for x, y in zip(i.tolist(), j.tolist(), strict=True) if comp[x] != comp[y]}
    assert len(pairs) == 300


def test_long_runs_meet_only_within_reach():
    """A third of a table with one passage of 56 of 71 shingles: its prefix places are too late for any link."""
    none = jaccard_join.reach(np.full(500, 71), np.full(500, 15), 75)
    at = np.arange(500)
    assert not list(jaccard_join.run_pairs(at, np.array([0]), np.array([500]), np.full(500, 71), none))
    rng = np.random.default_rng(3)
    sizes, places, comp = np.sort(rng.integers(60, 120, 400)), rng.integers(0, 30, 400), rng.integers(0, 9, 400)
    found = set()
    for i, j in jaccard_join.run_pairs(comp, np.array([0]), np.array([400]), sizes, jaccard_join.reach(sizes, places, 75)):
        found |= {(min(x, y), max(x, y)) for x, y in zip(i.tolist(), j.tolist(), strict=True)}
    for i in range(400):
        for j in range(i + 1, 400):
            most = min(sizes[i] - places[i], sizes[j] - places[j])
            if comp[i] != comp[j] and most >= jaccard_join.least_overlap(sizes[i], sizes[j], 75):
                assert (i, j) in found


def test_hot_shingles_are_dealt_over_many_buckets(spark, scratch, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", 16)
    base, passage = words(20, 80, 5000), words(21, 60, 5000)
    made = [(k, " ".join([f"edit{j}" for j in range(k)] + base[k:])) for k in range(60)]
    made += [(100 + k, " ".join(words(100 + k, 15, 5000) + passage)) for k in range(200)]
    made += [(400 + k, " ".join(passage + words(700 + k, 8 + k % 12, 5000))) for k in range(60)]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    levels = spark.sparkContext.broadcast(jaccard_join.frequency_levels(frame, 5))
    profile = scratch.table(frame.mapInArrow(lambda b: jaccard_join.profiles(b, levels, 5, 75), jaccard_join.PROFILE))
    groups = profile.selectExpr("doc_id as gid", "doc_id as comp", "1L as c")
    held = Counter()
    for r in jaccard_join.group_postings(profile, groups, 75, scratch).select("bucket", "part", "tokens").collect():
        held.update((r["bucket"], t) for t in np.frombuffer(r["tokens"], np.uint64).tolist())
    assert max(held.values()) <= 80
    packed = jaccard_join.group_postings(profile, groups, 75, scratch).groupBy("bucket").agg(F.countDistinct("part").alias("c"))
    assert packed.count() > 20 and packed.filter("c > 1").count() == 0
    met = {tuple(r) for r in jaccard_join.group_pairs(profile, groups, 75, scratch).collect()}
    sets = {k: shingles(t) for k, t in made}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                assert (a, b) in met
    found = jaccard_join.jaccard_components(frame, scratch)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute_components(made)


def test_hot_shingles_of_the_lowest_level(spark, scratch, monkeypatch):
    """Where the mean cell is above HOT, shingles of level 0 are hot, and bits that they share with others do no harm."""
    monkeypatch.setattr(jaccard_join, "HOT", 8)
    monkeypatch.setattr(jaccard_join, "HOT_BITS", 8 * 4096)
    cells = np.full(1 << jaccard_join.CELL_BITS, 100.0)
    monkeypatch.setattr(jaccard_join, "shingle_sketch", lambda texts, size: cells)
    assert jaccard_join.first_hot_level(cells) == 0
    passage = words(30, 60, 5000)
    made = [(k, " ".join(passage + words(900 + k, 4 + k % 16, 5000))) for k in range(120)]
    made += [(200 + k, " ".join(words(1200 + k, 30 + k % 9, 5000))) for k in range(120)]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    levels = spark.sparkContext.broadcast(jaccard_join.levels_of(cells))
    profile = scratch.table(frame.mapInArrow(lambda b: jaccard_join.profiles(b, levels, 5, 75), jaccard_join.PROFILE))
    grids = jaccard_join.hot_grids(profile, 75, 0).collect()
    assert grids and all(np.array([g["token"]]).view(np.uint64)[0] < 1 << 58 for g in grids)
    found = jaccard_join.jaccard_components(frame, scratch)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute_components(made)


def test_levels_bound_their_shingles():
    cells = np.random.default_rng(4).integers(0, 1 << 20, 1 << 12).astype(float) ** 2 / 1e6
    levels, bound = jaccard_join.levels_of(cells), jaccard_join.least_level_one(cells)
    assert (cells < bound * 2.0 ** levels).all()
    first = jaccard_join.first_hot_level(cells)
    assert (cells[levels < first] <= jaccard_join.HOT).all()


def test_parity_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for n, m, shared in ((5, 5, 5), (100, 700, 60), (3000, 3100, 2900), (0, 3, 0)):
        keys = rng.integers(0, 1 << 62, n + m, dtype=np.uint64)
        x, y = np.unique(keys[:n]), np.unique(np.concatenate([keys[: min(shared, n)], keys[n : n + m - min(shared, n)]]))
        difference = len(np.setxor1d(x, y))
        signs = [np.frombuffer(jaccard_join.parity(s), np.uint8) for s in (x, y)]
        assert jaccard_join.least_difference(*signs) <= difference


def test_components(spark, scratch, rows):
    links = [(k, k + 1) for k in range(20)] + [(50, 60), (60, 70), (50, 70), (80, 80)]
    found = components(spark.createDataFrame(links, "a long, b long"), scratch)
    assert rows(found) == sorted([(k, 0) for k in range(1, 21)] + [(60, 50), (70, 50)], key=repr)


# ---- mixing ----


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    assert mixing.targets([10, 500, 90], [3, 1, 1]) == [30, 300, 270]  # the last two reach 285 and then 270
    assert mixing.targets([0, 0], [1, 2]) == [0, 0]
    assert mixing.targets([], []) == []


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutation(size):
    assert sorted(mixing.permuted(np.arange(size), size, [1, 2, 3]).tolist()) == list(range(size))


def test_shards_share_the_slots():
    counts = np.array([5, 0, 1000, 333])
    seen, total = np.zeros(4, int), np.zeros(4, int)
    for shard in range(-(-counts.sum() // 100)):
        before, here = mixing.shard_counts(counts, 100, shard, 9)
        assert (before == total).all() and here.sum() <= 100
        total = total + here
    seen += total
    assert (seen == counts).all()


def test_draw_beyond_numpys_range():
    counts = np.array([3 * 10**9, 10**9, 7])
    out = mixing.draw(np.random.default_rng(1), counts, 2 * 10**9)
    assert out.sum() == 2 * 10**9 and (out <= counts).all() and (out >= 0).all()


def test_mix(docs, nothing, scratch, rows):
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(split(r[1]))
    order = sorted((s for s in sizes if s is not None), key=str) + [None]
    weights = [(1, 2, 3)[i % 3] for i in range(len(order))]
    wanted = dict(zip(order, mixing.targets([sizes[s] for s in order], weights), strict=True))
    plan = mixing.mix_sources(docs, scratch)
    found = plan.taken()
    assert sorted((r["doc_id"], r["size"]) for r in found.filter("doc_id is not null").collect()) == sorted(
        (r[0], len(split(r[1]))) for r in ROWS if r[0] is not None
    )
    totals = Counter()
    by_size = {(s, sizes[s], round(wanted[s], 6)) for s in sizes}
    for r in found.collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        source = next(s for s, n, t in by_size if n == r["source_size"] and t == round(r["target"], 6))
        totals[source] += r["taken"]
    for source in order:
        assert abs(totals[source] - wanted[source]) <= mixing.BLOCK_WORDS
    assert rows(found) == rows(mixing.mix_sources(docs, scratch).taken())
    assert mixing.mix_sources(nothing, scratch).taken().count() == 0


def test_mixed_documents(docs, spark, scratch):
    sizes = Counter()
    for r in ROWS:
        sizes[r[0]] += len(split(r[1]))
    counted, total = Counter(), 0
    for r in mixing.mixed_documents(docs, scratch).collect():
        counted[r["doc_id"]] += len(WORDS.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert all(n <= 3 * sizes[i] for i, n in counted.items())
    plan = mixing.mix_sources(docs, scratch).taken().collect()
    assert sum(counted.values()) == pytest.approx(sum(r["taken"] for r in plan), abs=4 * mixing.BLOCK_WORDS)
    # One id with two texts and a null, and rows without id: every text is there.
    made = [(1, "one two three", "en", "a"), (1, "four five", "en", "a"), (1, None, "en", "a"), (None, "six", None, None)]
    made += [(None, "seven", None, None)] * 2
    some = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    found = Counter((r["doc_id"], r["text"]) for r in mixing.mixed_documents(some, scratch).collect())
    assert {k for k in found} <= {(r[0], r[1]) for r in made} and len({t for _, t in found}) >= 3


def test_mix_of_many_sources(spark, scratch):
    """150,000 sources of a few words each, one of them with a third of all documents."""
    number = F.col("id")
    rows = spark.range(225_000).select(
        number.alias("doc_id"),
        F.repeat(F.lit("word "), (number % 5).cast("int")).alias("text"),
        F.when(number < 150_000, F.concat(F.lit("s"), number)).otherwise("s7").alias("source"),
    )
    found = mixing.mix_sources(rows, scratch, block_words=4).taken()
    sums = found.agg(F.sum("size"), F.sum("taken"), F.count("*"), F.max(F.col("taken") - 3 * F.col("size"))).head()
    assert sums[2] == 225_000 and sums[3] <= 0 and 0.8 * sums[0] <= sums[1] <= 1.2 * sums[0]


# ---- packing and token counts ----


def ids_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = ids_of.__dict__.setdefault("made", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_piece_bounds():
    assert packing.piece_bounds(3, 4) == [(0, 3)]
    assert packing.piece_bounds(8, 4) == [(0, 4), (4, 4)]
    assert packing.piece_bounds(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_best_fit_is_within_bounds():
    fills = np.random.default_rng(4).integers(1, 1024, 5000)
    bins = packing.best_fit(fills, 1024)
    assert sorted(i for b in bins for i in b) == list(range(5000))
    assert all(fills[b].sum() <= 1024 for b in bins)
    assert len(bins) <= 11 / 9 * -(-fills.sum() // 1024) + 1


@pytest.mark.parametrize("part_items", [50_000, 4])
def test_pack(docs, scratch, part_items):
    pieces = scratch.table(packing.token_pieces(docs, "doc_id", "text"))
    found = packing.pack_pieces(pieces, scratch, part_items=part_items).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append((r["start"], r["length"], r["piece"], r["ids_crc32"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, texts in {r[0]: [q[1] for q in ROWS if q[0] == r[0]] for r in ROWS}.items():
        ids = ids_of(texts[0]) + [2]
        raw = np.array(ids, "<u4")
        once = [
            (s, n, k, zlib.crc32(raw[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.piece_bounds(len(ids), 1024))
        ]
        assert sorted(by_doc[key]) == sorted(once * len(texts))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_pack_nothing(nothing, scratch):
    assert packing.pack_documents(nothing, scratch).count() == 0


def test_special_token_strings_and_long_runs_encode_alike():
    for text in ("a" * 5000, " " * 3000 + "x", "\n\n\t é " * 50, "1234567890" * 300):
        assert packing.encoder(packing.TOKENIZER)(text) == ids_of(text)


def test_token_counts(docs, nothing, scratch):
    found = token_counts.document_tokens(docs, scratch, block_tokens=64).collect()
    expected = Counter((r[0], len(ids_of(r[1]))) for r in ROWS)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in found) == expected
    assert token_counts.document_tokens(nothing, scratch).count() == 0


def test_separator_scan_over_any_blocks(spark):
    flat = np.random.default_rng(2).integers(0, 6, 500).astype("<u4")  # 0 separates
    cuts = [0, 0, 1, 2, 90, 91, 300, 500]
    blocks = [(7, k, flat[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    blocks += [(8, 0, np.array([5, 5], "<u4").tobytes()), (9, 0, b""), (9, 1, None)]
    found = token_counts.count_tokens(spark.createDataFrame(blocks, "file long, block long, tokens binary"), separator=0)
    expected, start = [], 0
    for at in [*np.flatnonzero(flat == 0).tolist(), len(flat)]:
        if at < len(flat) or at > start:
            expected.append((7, len(expected), start, at - start))
        start = at + 1
    assert sorted(tuple(r) for r in found.collect()) == [*expected, (8, 0, 0, 2)]


def test_flat_files_on_storage(spark, scratch, tmp_path):
    rng = np.random.default_rng(11)
    flats = {f"f{k}.bin": rng.integers(0, 40, n).astype("<u4") for k, n in enumerate((0, 1, 257, 1000))}
    flats["none.bin"] = np.ones(700, "<u4")  # no separator at all
    for name, flat in flats.items():
        flat.tofile(tmp_path / name)
    blocks = token_counts.flat_blocks(spark, str(tmp_path), block_tokens=64)
    assert blocks.count() == sum(-(-len(f) // 64) for f in flats.values())
    names = {r["file"]: r["path"].rsplit("/", 1)[1] for r in blocks.select("file", "path").distinct().collect()}
    found = Counter((names[r[0]], *r[1:]) for r in token_counts.count_tokens(blocks, 0, scratch).collect())
    expected = Counter()
    for name, flat in flats.items():
        start, ordinal = 0, 0
        for at in [*np.flatnonzero(flat == 0).tolist(), len(flat)]:
            if at < len(flat) or at > start:
                expected[name, ordinal, start, at - start] += 1
            start, ordinal = at + 1, ordinal + 1
    assert found == expected
    (tmp_path / "cut.bin").write_bytes(b"12345")
    with pytest.raises(Exception, match="no number of 32-bit ids"):
        token_counts.flat_blocks(spark, str(tmp_path)).collect()


# ---- language ID ----


def test_gradient_through_time():
    rng = np.random.default_rng(3)
    symbols, truth = rng.integers(0, 257, (6, 5)), rng.integers(0, 3, 5)
    weights = {k: v.astype(np.float64) for k, v in language_id.initial(3, 4, 1).items()}
    _, slopes = language_id.gradients({k: v.astype(np.float32) for k, v in weights.items()}, symbols, truth)
    for name, at in (("uf", (9, 2)), ("ub", (1, 3)), ("cf", (0, 0)), ("w", (1, 5)), ("eb", (symbols[2, 1], 10))):
        change = []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += sign * 1e-2
            change.append(language_id.gradients({k: v.astype(np.float32) for k, v in moved.items()}, symbols, truth)[0])
        assert slopes[name][at] == pytest.approx((change[0] - change[1]) / 2e-2, abs=2e-3)


def test_language_id(spark, docs, nothing):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learn = table.filter(~language_id.held_out("doc_id"))
    model = language_id.fit(learn, sample_docs=60)
    found = {r["doc_id"]: r for r in language_id.identify(table, model).collect()}
    truth = {r["doc_id"]: r["lang"] for r in table.select("doc_id", "lang").collect()}
    held = [i for i in found if found[i]["held_out"]]
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in found)
    assert np.mean([found[i]["lang_pred"] == truth[i] for i in held]) >= 0.9
    odd = language_id.identify(docs, model).collect()
    assert len(odd) == len(ROWS)
    for r in odd:
        text = next(q[1] for q in ROWS if q[0] == r["doc_id"])
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= r["score"] <= 1
    assert language_id.train_and_identify(nothing).count() == 0
    assert language_id.fit(nothing) is None
    carried = language_id.identify(docs, model, carry=("text", "n")).select("doc_id", "carry.text").collect()
    assert Counter((r[0], r[1]) for r in carried) == Counter((r[0], r[1]) for r in ROWS)


# ---- top-k search ----


def test_topk(spark, scratch):
    rng = np.random.default_rng(8)
    made = [(int(i), [float(x) for x in rng.normal(0, 0.3, 16).astype(np.float32)]) for i in range(300)]
    made += [(300, None), (320, [1.0, float("nan")]), (340, [float("inf")]), (360, [None, 1.0]), (380, [])]
    made += [(400, made[5][1]), (401, made[5][1]), (420, [0.0] * 16), (440, made[7][1][:5]), (None, made[5][1]), made[40]]
    frame = spark.createDataFrame([(*m, "clash") for m in made], "vec_id long, embedding array<float>, impacts string")
    valid = [
        (i, [int(np.floor(64 * float(x))) for x in v])
        for i, v in made
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    expected = []
    for q in sorted({i for i, _ in valid if i % 20 == 0}):
        mine = next(v for i, v in valid if i == q)
        scores = sorted((-sum(a * b for a, b in zip(mine, v, strict=False)), i) for i, v in valid if i != q)
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:20])]
    found = topk_search.top_k(frame, scratch)
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert topk_search.top_k(frame.limit(0), scratch).count() == 0


def test_search_stops_only_on_proof():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(0, 20, (500, 12)))
    query = np.floor(rng.normal(0, 20, (7, 12)))
    import pyarrow as pa

    table = pa.table({"vec_id": pa.array(range(500)), "impacts": pa.array([r.astype("<i8").tobytes() for r in rows])})
    index = topk_search.block_index(table)
    segments = [
        (np.frombuffer(s["cells"], "<i4"), np.frombuffer(s["impacts"], "<i8"), np.frombuffer(s["rest"], "<f8"))
        for s in index.column("segments")[0].as_py()
    ]
    exact = query @ rows.T
    for floors in (np.full(7, -np.inf), np.sort(exact, axis=1)[:, -5].copy(), np.full(7, exact.max() + 1)):
        at, row, score, processed = topk_search.best_of_block(query, np.full(7, -1), floors, np.arange(500), segments, 5)
        assert (score == exact[at, row]).all() and len(at) < 7 * 500
        for q in range(7):
            best = np.argsort(-exact[q], kind="stable")[:5]
            assert set(best[exact[q, best] >= floors[q]]) <= set(row[at == q])
        if np.isfinite(floors).all():
            assert processed.sum() < 7 * len(segments)


def test_topk_over_many_blocks(spark, scratch, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk_search, "TILES", 2)
    rng = np.random.default_rng(9)
    x = rng.normal(0, 0.2, (600, 8)).astype(np.float32)
    x[200:300] = x[200]  # a hot vector, so that the last places are ties
    ids = [k if k < 400 else 7 for k in range(600)]  # a third of all rows share an id
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")
    q = np.floor(64 * x.astype(np.float64)).astype(np.int64)
    expected = []
    for a in range(0, 400, 20):
        scores = sorted((-int(q[a] @ q[b]), ids[b]) for b in range(600) if ids[b] != a)
        expected += [(a, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:20])]
    found = topk_search.top_k(frame, scratch)
    assert sorted(tuple(r) for r in found.collect()) == expected


# ---- HTML extraction ----


def test_extraction_of_held_out_pages():
    model = html_extraction.fitted()
    pages = [html_extraction.Page(p) for p in html_extraction.labelled_pages(80, 1234)]
    forest = html_extraction.Forest(pages)
    marginal, _ = forest.infer(*model)
    truth = np.array([bool(html_extraction.KEEP.search(r)) for p in pages for r in p.rests])
    assert ((marginal >= 0.5) == truth).mean() >= 0.95


def test_marginals_against_enumeration():
    page = html_extraction.Page("<body><nav><a href=x>a</a></nav><article><p>some words</p><div class=ad>b</div></article></body>")
    forest = html_extraction.Forest([page])
    rng = np.random.default_rng(2)
    weights, pairs = rng.normal(0, 1, html_extraction.FEATURES), rng.normal(0, 1, (3, 2, 2))
    marginal, _ = forest.infer(weights, pairs)
    count = len(page.tags)
    total, on = 0.0, np.zeros(count)
    for state in range(1 << count):
        bits = [(state >> k) & 1 for k in range(count)]
        value = sum(weights[c] for r, c in zip(forest.rows, forest.columns, strict=True) if bits[r])
        value += sum(pairs[forest.kind[k], bits[p], bits[k]] for k, p in enumerate(forest.parent) if p >= 0)
        total += np.exp(value)
        on += np.exp(value) * np.array(bits)
    assert marginal == pytest.approx(on / total)


# A tag with quoted values, read by trying every place anew.
SLOW_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>")
SLOW_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>", re.S)


def test_markup_is_that_of_a_plain_search():
    rng = np.random.default_rng(6)
    pieces = ["<", ">", '"', "'", "/", "<a ", "</a>", "<B", '<p x="', "<!--", "-->", "<!", "<?", "<![CDATA[", "]]>", "t", " ", "=", "<a'b>"]
    for _ in range(4000):
        page = "".join(pieces[k] for k in rng.integers(len(pieces), size=rng.integers(12)))
        expected, at = [], 0
        while at < len(page):
            if found := SLOW_OTHER.match(page, at):
                expected.append((at, found.end(), False, "", ""))
            elif found := SLOW_TAG.match(page, at):
                expected.append((at, found.end(), bool(found[1]), found[2].lower(), found[3]))
            at = found.end() if found else at + 1
        markup, got, at = html_extraction.Markup(page), [], 0
        while found := markup.next(at):
            got.append(found)
            at = found[1]
        assert got == expected, page


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<span>" * n + "</i>" * n,
        lambda n: "<p><button>" + "<span>" * n + "<hr>" * n,
        lambda n: "<a " * n,
        lambda n: "<a" * n,
        lambda n: "<a \"" * n + "'",
        lambda n: "<a '\"" * n,
        lambda n: "<!" * n,
        lambda n: "<script>" + "</script " * n,
    ],
)
def test_broken_pages_of_a_megabyte(page):
    begin = time.process_time()
    html_extraction.Page(page(100_000))
    assert time.process_time() - begin < 20


def test_pages_unlike_the_layouts():
    """Pages written by hand, each block labelled by hand."""
    story = "The river rose through the night and by dawn the lower fields were under water, farmers said on Tuesday."
    again = "Nobody was hurt, but two roads stay closed until the bridge has been inspected by engineers from the county."
    pages = [
        f"<html><body><table><tr><td class=nav><a href=1>Home</a> <a href=2>News</a></td><td><h1>Flood</h1><p>{story}<p>{again}</td></tr></table>"
        "<div id=footer>Copyright 2020 <a href=3>Terms</a></div></body></html>",
        f"<body><header><div class='logo'><a href=/>Site</a></div></header><main><section><h2>Flood</h2><div>{story}</div></section>"
        f"<section><p>{again}</p></section></main><aside class='related'><ul><li><a href=a>Other one</a></li><li><a href=b>Other two</a></li></ul></aside></body>",
        f"<body><div class='post-content'><p>{story}</p><blockquote><p>{again}</p></blockquote></div>"
        "<section id='comments'><h3>2 replies</h3><p>I live there and it was very bad indeed, we lost the car.</p></section>"
        "<script>var a = '<p>no</p>';</script></body>",
    ]
    texts = html_extraction.main_texts(pages, html_extraction.fitted())
    for text in texts:
        assert story in text and again in text
    gone = ["Home", "Copyright", "Terms", "Site", "Other one", "replies", "very bad", "var a"]
    assert not [g for text in texts for g in gone if g in text]


def test_extract(spark, rows):
    article = "<article><h1>Tom &amp;amp; Co</h1><p>First  line<br>goes\non &lt;here&gt;.<p>" + "word " * 60 + "</p></article>"
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><!-- x --><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        f"<div class='cookie'>We use cookies</div>{article}<form><label>Mail</label><input></form>"
        "<div id='comments'><p>Nice one</p></div><aside><p>More</p></aside><footer>&copy; me</footer></body></html>"
    )
    made = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", "<p", "x"), (4, "z", "</b></p><!--", "x")]
    found = html_extraction.extract(spark.createDataFrame(made, "page_id long, url string, html string, text string"))
    text = "Tom &amp; Co\nFirst line goes on <here>.\n" + " ".join(["word"] * 60)
    by_id = defaultdict(list)
    for r in found.collect():
        by_id[r["page_id"]].append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert by_id[1] == [text, text] and by_id[2] == [""] and by_id[None] == [""] and by_id[4] == [""]
    assert len(by_id[3]) == 1
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert len(html_extraction.main_texts([deep, "<" * 50_000, "<a '" * 5000], html_extraction.fitted())) == 3


# ---- repeated passages ----


def test_repeated_passages(docs, nothing, scratch):
    counted = [r for r in ROWS if r[0] is not None]
    runs = {n: Counter() for n in (25, 50)}
    for r in counted:
        w = split(r[1])
        for n, counter in runs.items():
            counter.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    found = defaultdict(set)
    by_id = {r[0]: split(r[1]) for r in counted}
    for r in suffix_dedup.repeated_passages(docs, scratch).collect():
        w, start, end = by_id[r["doc_id"]], r["start_word"], r["start_word"] + r["n_words"]
        assert r["n_words"] >= 50 and end <= len(w)
        assert all(runs[25][tuple(w[i : i + 25])] > 1 for i in range(start, end - 24))
        assert not r["removable"] or r["other_doc_id"] < r["doc_id"]
        found[r["doc_id"]].update(range(start, end))
    for key, w in by_id.items():
        for i in range(len(w) - 49):
            if runs[50][tuple(w[i : i + 50])] > 1:
                assert found[key] >= set(range(i, i + 50))
    assert set(found) == {7, 8, 9, 11, 12, 13, 14, 15}
    assert suffix_dedup.repeated_passages(nothing, scratch).count() == 0


def test_removal_leaves_every_repeated_run(spark, scratch):
    """Chained quotes, variants, copies and repetitions: each repeated run of 50 words stays in some document."""
    a, b, c, d = (words(50 + k, 30, 5000) for k in range(4))
    long, base = words(60, 200, 5000), words(61, 150, 5000)
    texts = {
        2: a + b, 5: a + b + c, 9: b + c, 12: c + d + a, 13: c + d + a + b, 20: long, 21: long[:120] + words(62, 50, 5000),
        22: words(63, 50, 5000) + long[80:], 23: long, 24: long[:120] + long[80:], 30: base + base, 31: base[70:] + base[:90],
        32: words(64, 70, 5000) + base, 33: a + b + long + base + c,
    }
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")

    def runs(text):
        return [tuple(text[i : i + 50]) for i in range(len(text) - 49)]

    counted = Counter(r for t in texts.values() for r in runs(t))
    kept, gone = {k: list(t) for k, t in texts.items()}, set()
    for r in suffix_dedup.repeated_passages(docs, scratch).filter("removable").collect():
        assert r["n_words"] >= 50 and r["other_doc_id"] < r["doc_id"]
        at = range(r["start_word"], r["start_word"] + r["n_words"])
        gone |= {(r["doc_id"], i) for i in at}
    for key, i in gone:
        kept[key][i] = None
    left = {r for t in kept.values() for r in runs(t)}
    assert {r for r, n in counted.items() if n > 1} <= left
    # Nothing more could go: the words of runs that a smaller document holds, but for those of first runs.
    first = {}
    for key in sorted(texts):
        for r in runs(texts[key]):
            first.setdefault(r, key)
    for key, text in texts.items():
        goes, stays = set(), set()
        for i, r in enumerate(runs(text)):
            if counted[r] > 1:
                (goes if first[r] < key else stays).update(range(i, i + 50))
        parts = [i for i in sorted(goes - stays)]
        cuts = [k for k, i in enumerate(parts) if not k or parts[k - 1] != i - 1] + [len(parts)]
        expected = {i for x, y in zip(cuts[:-1], cuts[1:], strict=True) if y - x >= 50 for i in parts[x:y]}
        assert {i for k, i in gone if k == key} == expected
    assert {i for k, i in gone if k == 23} == set(range(200))


# ---- licence scan ----


def test_license_scan(spark, scratch):
    mit = license_scan.TEMPLATES["MIT"][2]
    prose = " ".join(words(1, 200))
    made = [
        (1, "a/LICENSE", mit), (2, "a/x.py", prose), (3, "a/b/c/y.py", prose), (4, "a/b/z.py", license_scan.TEMPLATES["Apache-2.0"][0] + "\n" + prose),
        (5, "a/b/COPYING.txt", "Licensed under CC BY-NC 4.0."), (6, "d/w.py", prose), (7, "top.py", prose), (8, None, None), (9, "a/b", ""),
        (10, "a/bb/k.py", "x\n# SPDX-License-Identifier: BSD-2-Clause\n"), (2, "a/x.py", prose),
    ]
    frame = spark.createDataFrame([(*m, "x") for m in made], "doc_id long, path string, text string, license string")
    found = defaultdict(list)
    for r in license_scan.scan_licenses(frame, scratch).collect():
        found[r["doc_id"]].append((r["license"], r["basis"], r["from_path"]))
    inherited = ("MIT", "inherited", "a/LICENSE")
    assert found[1] == [("MIT", "own", "a/LICENSE")]
    assert found[2] == [inherited] * 2
    assert found[3] == [("CC-BY-NC-4.0", "inherited", "a/b/COPYING.txt")]
    assert found[4][0][:2] == ("Apache-2.0", "own")
    assert found[5][0][:2] == ("CC-BY-NC-4.0", "own")
    assert found[6] == found[7] == found[8] == [(None, None, None)]
    assert found[9] == [inherited]
    assert found[10][0][:2] == ("BSD-2-Clause", "own")
    assert license_scan.scan_licenses(frame.limit(0), scratch).count() == 0


# ---- caps, repeated and missing ids ----


def test_exact_copies_are_dropped_by_row(spark):
    made = [(1, "T"), (1, "U"), (2, "t"), (None, "V"), (None, "T"), (3, None), (4, "")]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    found = exact_dedup.drop_exact_duplicates(docs).collect()
    assert Counter(map(tuple, found)) == Counter([(1, "U"), (2, "t"), (None, "V"), (4, "")])


def test_a_third_of_the_ids_missing(spark, scratch):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.repeat(F.lit("some words "), (F.col("id") % 90).cast("int")).alias("text")
    )
    pieces = scratch.table(packing.token_pieces(rows, "doc_id", "text"))
    found = packing.pack_pieces(pieces, scratch, part_items=1000)
    sums = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sums.filter("n != end or n > 1024").count() == 0 and found.count() == pieces.count()
    assert found.filter("doc_id is null").count() == 3000
    assert sums.count() <= 1.02 * found.agg(F.sum("length")).head()[0] / 1024 + 2


def test_more_labels_than_sixty_four(spark):
    """Every one of 70 languages is learnt, and one row repeated many times counts once."""
    rng = np.random.default_rng(8)
    letters = [chr(c) for c in range(97, 123)]
    kinds = [["".join(rng.choice(letters, 3)) for _ in range(4)] for _ in range(70)]
    made = []
    for i in range(70 * 12):
        made.append((i, " ".join(kinds[i % 70][k] for k in rng.integers(0, 4, 40)), f"l{i % 70:02}"))
    made += [made[0]] * 5000
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string").repartition(4)
    model = language_id.fit(docs)
    assert model.names == [f"l{k:02}" for k in range(70)]
    found = language_id.identify(docs.limit(5840).dropDuplicates(), model).collect()
    truth = {i: lang for i, _, lang in made}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in found) >= 0.9 * len(found)


def test_licence_scores(spark, scratch):
    """Scores of a line of 20,000 words and of short ones are the cosines of a plain sum; a threshold may be low."""
    mit = license_scan.TEMPLATES["MIT"][2]
    texts = [mit, " ".join([mit] * 400), "without restriction use copy modify merge publish " + " ".join(words(11, 6)), "no licence at all"]
    assert len(texts[1].split()) > 18_000
    docs = spark.createDataFrame([(i, t, f"d/{i}.txt") for i, t in enumerate(texts)], "doc_id long, text string, path string")
    found = {r["doc_id"]: r for r in license_scan.own_licenses(docs.select("doc_id", "path", "text"), threshold=0.05).collect()}
    tokens = [license_scan.TERM.findall(t.lower()) for t in texts]
    known = {w for ts in license_scan.TEMPLATES.values() for t in ts for w in license_scan.terms(t)}
    weight = lambda w: np.log(5 / (1 + sum(w in t for t in tokens if w in known))) + 1

    def cosine(one, other):
        a, b = ({w: (1 + np.log(n)) * weight(w) for w, n in Counter(x).items()} for x in (one, other))
        dot = sum(v * b.get(w, 0) for w, v in a.items())
        return dot / np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    for i, text in enumerate(tokens):
        best = max(cosine(text, license_scan.TERM.findall(t.lower())) for ts in license_scan.TEMPLATES.values() for t in ts)
        assert found[i]["score"] == pytest.approx(best if best >= 0.05 else 0, abs=1e-9) or best < 0.05
    assert found[1]["license"] == "MIT" and found[1]["score"] > 0.9 and found[2]["license"] == "MIT"
    assert 0.05 < found[2]["score"] < license_scan.THRESHOLD
