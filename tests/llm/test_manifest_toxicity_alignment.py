"""Merkle manifest, toxicity and token alignment against brute force, with nulls, repeats, long texts and no rows."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_operators import ASCII, CLASHING, ROWS, SCHEMA, words

from veritally.llm import alignment, merkle, toxicity
from veritally.llm.common import Scratch

DOCS = "/root/testdata/sf0.01/documents.parquet"
LABELS = "/root/testdata/sf0.01/labels.parquet"
FULL = SCHEMA + ", n_chars int, block string, tree string, at string, digest string, place string"
EXTRA = ("x",) * 5


def with_sizes(rows):
    return [r + (None if i % 7 == 3 else len(r[1] or ""), *EXTRA) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def scratch(spark):
    with Scratch(spark, "tests") as made:
        yield made


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(with_sizes(ROWS), FULL).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], FULL)


# ---- Merkle manifest ----


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree_of(leaves):
    """(root, for each leaf the runs it meets as (place, run) from below) level by level."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, way in enumerate(ways):
            run = at[i] // 16 * 16
            way.append((at[i] - run, level[run : run + 16]))
            at[i] //= 16
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], ways


def brute_manifest(rows):
    by_source = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = leaf_of(doc_id, source, lang, n_chars, text)
        changed = leaf
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            changed = leaf_of(doc_id, source, lang, n_chars, text.translate(ASCII))
        by_source.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, changed))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree_of([r[2] for r in sorted(by_source[s])]) for s in names]
    root, tops = tree_of([t[0] for t in trees])
    out = []
    for name, (subroot, ways), top in zip(names, trees, tops, strict=True):
        for (_, _, leaf, doc_id, changed), way in zip(sorted(by_source[name]), ways, strict=True):
            proof, folded = "", changed
            for place, run in way + top:
                proof += "".join(run[:place] + run[place + 1 :])
                folded = sha("".join([*run[:place], folded, *run[place + 1 :]]))
            out.append((doc_id, leaf, subroot, root, sha(proof), folded, folded == root))
    return sorted(out, key=repr)


def plain(rows):
    return [(r[0], r[1], r[2], r[3], r[4 + len(CLASHING)]) for r in rows]


@pytest.mark.parametrize("height", [1, 3])
def test_merkle_fixture(docs, scratch, rows, height):
    assert rows(merkle.merkle_manifest(docs, scratch, height)) == brute_manifest(plain(with_sizes(ROWS)))


@pytest.mark.parametrize("height", [1, 2, 3])
def test_merkle_hot_source_and_many_small_ones(spark, scratch, rows, height):
    # 4,500 rows of one source (more than a superblock), 300 of their own, one id in a third of the rows, null ids.
    made = []
    for i in range(4500):
        made.append((7 if i % 3 == 0 else None if i % 50 == 1 else i, f"Text {i % 90}", "en", "hot", i % 4))
    made += [(i, "A", None, f"s{i}" if i % 9 else "é" * (i % 5 + 1), None) for i in range(300)]
    frame = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars int").repartition(7)
    found = merkle.merkle_manifest(frame, scratch, height)
    assert rows(found) == brute_manifest(made)


def test_merkle_edges(spark, scratch, rows, nothing):
    assert merkle.merkle_manifest(nothing, scratch).count() == 0
    one = [(None, None, None, None, None)]
    frame = spark.createDataFrame(one, "doc_id long, text string, lang string, source string, n_chars int")
    found = rows(merkle.merkle_manifest(frame, scratch))
    assert found == brute_manifest(one)
    assert found[0][1] == sha("-----") == found[0][3] and found[0][4] == sha("") and found[0][6]


def test_merkle_tampering_is_seen(spark, scratch):
    docs = spark.read.parquet(DOCS)
    found = merkle.merkle_manifest(docs, scratch).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found:
        chosen = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        text = texts[r["doc_id"]]
        assert r["verified"] == (not chosen or text is None or text == text.translate(ASCII))


# ---- toxicity ----


def brute_features(text):
    """Buckets of the n-grams of a text, by a plain loop."""
    folded = bytearray(b" ")
    for byte in (text or "").translate(ASCII).encode():
        byte = byte if byte >= 128 or chr(byte).isalnum() else 32
        if byte != 32 or folded[-1] != 32:
            folded.append(byte)
    if folded[-1] != 32:
        folded.append(32)
    out = set()
    for size in toxicity.ORDERS:
        for i in range(len(folded) - size + 1):
            h = folded[i]
            for byte in folded[i + 1 : i + size]:
                h = (h * 0x01000193 + byte) % 2**32
            h = ((h ^ (h >> 15)) + size * 0x85EBCA6B) % 2**32
            out.add((h * 0x9E3779B1 % 2**32) >> (32 - toxicity.BUCKET_BITS))
    return out


def labelled(spark):
    """2,000 short texts of which some hold a word of the toxic stem; labels of ids the texts do not have, too."""
    rng = np.random.default_rng(5)
    made = []
    for i in range(2000):
        text = words(100 + i, 30, 5000)
        toxic = int(rng.random() < 0.2)
        if toxic:
            text[rng.integers(0, 30)] = "Grob" + "abcdefgh"[rng.integers(0, 8)] + "!"
        made.append((i, " ".join(text), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
    marks = [(i, x) for i, _, x in made] + [(None, 1), (5000, 1), (5001, 7), (5002, None)]
    return made, docs, spark.createDataFrame(marks, "doc_id long, toxic int")


def test_toxicity_learns_and_scores_as_a_plain_loop(spark, scratch):
    made, docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels, scratch)
    train = [(brute_features(t), x) for i, t, x in made if zlib.crc32(str(i).encode()) % 4 != 2]
    totals = Counter(x for _, x in train)
    counts = [Counter(b for f, x in train if x == kind for b in f) for kind in (0, 1)]
    clear = {}
    for b in counts[0].keys() | counts[1].keys():
        clean, toxic = counts[0][b] + 1, counts[1][b] + 1
        ratio = np.log(toxic / (totals[1] + 2)) - np.log(clean / (totals[0] + 2))
        if abs(ratio) >= max(toxicity.LEAST_RATIO, toxicity.LEAST_Z * (1 / toxic + 1 / clean) ** 0.5):
            clear[b] = ratio
    assert set(model.buckets.tolist()) == set(clear)
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    right = 0
    for i, text, toxic in made:
        z = model.bias + sum(weight.get(b, 0.0) for b in brute_features(text))
        assert found[i]["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
        assert found[i]["predicted"] == int(found[i]["score"] >= 0.3)
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        right += found[i]["held_out"] and found[i]["predicted"] == toxic
    assert right >= 0.98 * sum(r["held_out"] for r in found.values())
    again = toxicity.fit(docs.repartition(5), labels.repartition(3), scratch)
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_toxicity_gradient():
    """The fit ends where the penalised loss is flat."""
    rng = np.random.default_rng(3)
    dense = rng.random((300, 5)) < 0.4
    truth = (rng.random(300) < 1 / (1 + np.exp(-(dense @ [2, -2, 1, 0, 0] - 0.5)))).astype(float)
    rows, places = np.nonzero(dense)
    ratio, weight = np.array([1.5, -1.2, 0.7, 0.1, -0.1]), np.where(truth == 1, 1.0, 3.0)
    weights, bias = toxicity.logistic(rows, places, truth, ratio, weight)
    error = weight / weight.sum() * (1 / (1 + np.exp(-(dense @ weights + bias))) - truth)
    grad = ratio * (dense.T @ error) + toxicity.PENALTY * weights / ratio
    assert np.abs(grad).max() < 2e-3 and abs(error.sum()) < 2e-3


def test_toxicity_edges(spark, docs, nothing, scratch):
    _, some, labels = labelled(spark)
    model = toxicity.fit(some, labels, scratch)
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    empty = 1 / (1 + np.exp(-model.bias))
    assert all(r["score"] == pytest.approx(empty) for r in found if r["doc_id"] in (0, 1))
    assert all(not r["held_out"] for r in found if r["doc_id"] is None)
    assert toxicity.score(nothing, model).count() == 0
    for marks in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("toxic = 1"), labels.filter("doc_id > 4000")):
        assert len({r["score"] for r in toxicity.score(some, toxicity.fit(some, marks, scratch)).collect()}) == 1
    assert toxicity.score(some, toxicity.fit(nothing, labels, scratch)).count() == 2000
    # A long text with the words in its middle, and repeats of an id with both labels.
    long = " ".join([*words(1, 30_000, 5000), "groba", "grobb", "grobc", *words(2, 30_000, 5000)])
    both = labels.union(labels.withColumn("toxic", 1 - labels["toxic"]).filter("doc_id < 4"))
    doubled = toxicity.fit(some.union(some.filter("doc_id < 4")), both, scratch)
    assert toxicity.score(spark.createDataFrame([(1, long)], "doc_id long, text string"), doubled).head()["predicted"] == 1


def test_toxicity_on_held_out_documents(spark, scratch):
    docs, labels = spark.read.parquet(DOCS), spark.read.parquet(LABELS)
    found = toxicity.score(docs, toxicity.fit(docs, labels, scratch)).filter("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in found) >= 0.9 * len(found)


# ---- alignment of two tokenizers ----


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # Byte-level entries write each byte as a printable character: these, and the others from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}

    def a_bytes(i):
        return bytes(byte_of[c] for c in a_side.id_to_token(i))

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def spans(ids, of):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(of(i))))
            at = out[-1][2]
        return out

    made = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_side.encode(text or "")
        if not text or b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            made.append(((), (), [], ""))
            continue
        a, b = spans(a, a_bytes), spans(b, b_bytes)
        links = [(x, y) for x, s, e in a for y, u, v in b if max(s, u) < min(e, v)]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for low, high in zip([0, *cuts[:-1]], cuts, strict=True):
            sides = [",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in (a, b)]
            groups.append("|".join(sides))
        made.append((a, b, links, ";".join(groups)))
    count = Counter(pair for *_, links, _ in made for pair in set(links))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    return [
        (len(a), len(b), len(groups.split(";")) if groups else 0, len(links), sum(count[p] == most[p[0]] for p in links),
         sum(count[p] for p in links), sha(groups) if groups else "")
        for a, b, links, groups in made
    ]


ALIGN_TEXTS = [
    None, "", " ", "  two  spaces ", "One", "one One", "tab\tand\nline\r\n", "Ünïcode ﬁne ½ é", "你好 世界",
    "under▁bar", "<s> </s> <unk> <0x41> <|endoftext|>", "😀😀 👩‍👩‍👧", "a" * 300, "\x00\x01 nul", "İstanbul ǅ",
    " ".join(words(9, 150)), " ".join(words(9, 150)).upper(), "One", "import numpy as np\n\tx = np.zeros(3)",
    "".join(chr(c) for c in range(0x400, 0x460)), " nbsp 　wide", "123456789 3.14159",
]


def test_alignment_against_brute_force(spark, scratch, rows):
    made = [(i, t, *["x"] * 3) for i, t in enumerate(ALIGN_TEXTS)] + [(None, "One", *["x"] * 3)]
    frame = spark.createDataFrame(made, "doc_id long, text string, block string, pairs string, docs string").repartition(4)
    found = rows(alignment.align_tokenizers(frame, scratch))
    want = [(r[0], *b) for r, b in zip(made, brute_alignment([r[1] for r in made]), strict=True)]
    assert found == sorted(want, key=repr)
    assert any(r[1] == 0 and t for r, t in zip(want, ALIGN_TEXTS, strict=False))


def test_alignment_over_blocks(spark, scratch, rows):
    """Counts over many partitions, a text beyond a block, and repeated rows."""
    texts = [" ".join(words(i % 40, 60, 90)) for i in range(400)] + ["again and again"] * 50
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(9)
    want = [(i, *b) for i, b in enumerate(brute_alignment(texts))]
    assert rows(alignment.align_tokenizers(frame, scratch)) == sorted(want, key=repr)


def test_alignment_edges(spark, scratch, docs, nothing):
    assert alignment.align_tokenizers(nothing, scratch).count() == 0
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in alignment.align_tokenizers(empty, scratch).collect()) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, ""),
    ]
    assert alignment.align_tokenizers(docs, scratch).count() == len(ROWS)
    long = "word " * 400_000 + " " * 600_000 + "end"
    frame = spark.createDataFrame([(1, long), (2, "word end")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in alignment.align_tokenizers(frame, scratch).collect()}
    assert found[1]["n_links"] == found[1]["n_a"] + found[1]["n_b"] - found[1]["n_groups"]
    assert found[2]["n_a"] == 2
