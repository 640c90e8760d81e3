"""Vector codes, clusters and token-id files against brute force and the tokenizers library."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from batchloom.llm import bpe, idfiles, laesa, pqcodes, queries
from batchloom.storage import work_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, vector string, id long, part long, cluster int, code string"


def vector_rows(dims=64):
    """Vectors with nulls, bad components, other lengths, copies, ties, far outliers, null ids and equal ids."""
    rng = random.Random(3)
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(6)]
    near = lambda c, s: [x + rng.gauss(0, s) for x in c]
    vectors = [near(centres[i % 6], 0.1) for i in range(150)]
    vectors += [vectors[0]] * 90 + [[0.0] * dims, [-0.0] * dims, [900.0] * dims, [0.5, -0.5] * (dims // 2)]
    vectors += [None, [], [1.0] * (dims - 1), [None] + [0.0] * (dims - 1), [float("nan")] * dims, [float("-inf")] * dims]
    rows = [(i * 7 % 401, v, None if i % 4 == 0 else i % 3, "x", 1, 2, 3, "c") for i, v in enumerate(vectors)]
    rows += [(None, vectors[3], 1, None, None, None, None, None), (0, vectors[9], None, "y", 0, 0, 0, ""), rows[5]]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), VECTORS).repartition(3).cache()


@pytest.fixture(scope="module")
def no_vectors(spark):
    return spark.createDataFrame([], VECTORS)


def whole(rows, dims=64):
    kept = [r for r in rows if r[1] and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(r[0], tuple(math.floor(256 * float(np.float32(x))) for x in r[1]), r[2]) for r in kept]


def closest(point, entries):
    return min((sum((a - b) ** 2 for a, b in zip(point, e)), i) for i, e in enumerate(entries))


def means(groups, entries):
    return [tuple(sum(c) // len(groups[i]) for c in zip(*groups[i])) if groups[i] else e for i, e in enumerate(entries)]


# -- centroid clustering


def brute_clusters(rows, k, rounds):
    kept = whole(rows)
    named = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v, _ in sorted(kept, key=named)[:k]]
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v, _ in kept:
            groups[closest(v, centroids)[1]].append(v)
        centroids = means(groups, centroids)
    return [(i, *closest(v, centroids)[::-1]) for i, v, _ in kept], centroids


@pytest.mark.parametrize("k, rounds, pivots", [(12, 4, 5), (400, 2, 8), (1, 1, 1)])
def test_clusters_equal_brute_force(vectors, k, rounds, pivots):
    expected, centroids = brute_clusters(vector_rows(), k, rounds)
    assigned, found = laesa.cluster_vectors(vectors, k=k, rounds=rounds, pivots=pivots)
    assert Counter(map(tuple, assigned.collect())) == Counter(expected)
    assert [tuple(v) for _, v in sorted(found.collect())] == centroids
    total, per = sum(d for _, _, d in expected), Counter()
    for _, c, d in expected:
        per[c] += d
    for r in laesa.with_inertia(assigned, found).collect():
        digest = hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
        assert (r.cluster_inertia, r.inertia, r.centroid_sha256) == (per[r.cluster], total, digest)


def test_pivots_spare_distances_and_lose_none():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-4000, 4000, (40, 16))
    rows = centroids[rng.integers(0, 40, 3000)] + rng.integers(-300, 300, (3000, 16))
    rows[:200] = (centroids[0] + centroids[1]) // 2 * 2 // 2  # near ties
    pivots = laesa.spread_pivots(centroids, 8)
    table, to_pivots = laesa.pivot_distances(rows, pivots), laesa.pivot_distances(centroids, pivots)
    cluster, distance, computed = laesa.nearest(rows, table, centroids, to_pivots)
    every = ((rows[:, None, :] - centroids[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert computed < every.size / 2


def test_no_vectors_no_clusters(no_vectors):
    assigned, centroids = laesa.cluster_vectors(no_vectors)
    assert laesa.with_inertia(assigned, centroids).collect() == [] == centroids.collect()


def test_components_beyond_the_limit_are_an_error(spark):
    far = spark.createDataFrame([(1, [1e30] * 64, 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="too large for exact distances"):
        laesa.cluster_vectors(far)


# -- vector codes


def brute_codes(rows, entries, rounds, parts=16):
    kept, size = whole(rows), 64 // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[closest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = means(groups, books[p])
    out, labels = [], Counter()
    for i, v, label in kept:
        found = [closest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, tuple(e for _, e in found), sum(d for d, _ in found)))
        labels[label] += out[-1][3]
    return [(*r, labels[r[1]]) for r in out], books


@pytest.mark.parametrize("entries, rounds", [(16, 2), (64, 1), (1, 1), (1000, 1)])
def test_codes_equal_brute_force(vectors, entries, rounds):
    expected, books = brute_codes(vector_rows(), entries, rounds)
    coded, found = pqcodes.quantise(vectors, entries=entries, rounds=rounds)
    rows = pqcodes.with_label_error(coded).collect()
    assert Counter((r.vec_id, r.label, tuple(r.code), r.error, r.label_error) for r in rows) == Counter(expected)
    flat = [x for book in books for entry in book for x in entry]
    assert pqcodes.books_digest(found) == hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def test_codes_over_several_slabs_and_wide_parts(vectors, monkeypatch):
    monkeypatch.setattr(pqcodes, "SLAB_ROWS", 50)
    expected, _ = brute_codes(vector_rows(), 8, 2, parts=4)
    coded, _ = pqcodes.quantise(vectors, parts=4, entries=8)
    assert Counter((r.vec_id, r.label, tuple(r.code), r.error) for r in coded.collect()) == Counter(e[:4] for e in expected)


def test_no_vectors_no_codes(no_vectors):
    coded, books = pqcodes.quantise(no_vectors)
    assert pqcodes.with_label_error(coded).collect() == [] and books.size == 0


@pytest.mark.parametrize("d, side", [(2, 16), (3, 8), (4, 4)])
def test_hilbert_neighbours_differ_by_one_step(d, side):
    grid = np.stack(np.meshgrid(*[np.arange(side)] * d, indexing="ij"), -1).reshape(-1, d)
    path = grid[pqcodes.hilbert_order(grid * (1 << 60 // d) // side)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_hilbert_order_of_many_axes_is_an_order():
    points = np.random.default_rng(0).integers(-(1 << 27), 1 << 27, (100, 200))
    assert sorted(pqcodes.hilbert_order(points)) == list(range(100))


def test_shortlists_hold_the_nearest_and_leave_most_out():
    rng = np.random.default_rng(2)
    points, entries = rng.integers(-200, 200, (4000, 4)), rng.integers(-200, 200, (64, 4))
    blocks, _, _ = pqcodes.blocks_of(points)
    listed = pqcodes.shortlists(blocks.min(1), blocks.max(1), entries)
    nearest = ((blocks[:, :, None, :] - entries) ** 2).sum(3).argmin(2)
    assert np.take_along_axis(listed, nearest, axis=1).all()
    assert listed.mean() < 0.6


# -- token-id files


def greedy_words(ids):
    """Words of a block by trying every packing, widest count first."""
    words, at = 0, 0
    while at < len(ids):
        for count, bits in sorted(idfiles.LANES.values(), reverse=True):
            if all(i < 1 << bits for i in ids[at : at + count]):
                break
        else:
            count, words = 1, words + 1  # the escaped id takes a word of its own
        words, at = words + 1, at + count
    return words


ids_of_all_widths = st.lists(st.integers(0, 64).flatmap(lambda b: st.integers(0, (1 << b) - 1)), max_size=300)


@settings(max_examples=200, deadline=None)
@given(ids_of_all_widths)
def test_blocks_round_trip(ids):
    array = np.array(ids, np.uint64)
    words, escaped = idfiles.pack_block(array)
    assert escaped == sum(i >> 60 > 0 for i in ids)
    assert len(words) == greedy_words(ids)
    assert idfiles.unpack_block(words, escaped, len(ids)).tolist() == ids


def test_blocks_of_zeros_and_runs():
    for ids in ([0] * 1000, [1] * 61, [0] * 119 + [7], [0] * 500 + [1 << 63] + [0] * 500, [50256] * 100):
        words, escaped = idfiles.pack_block(np.array(ids, np.uint64))
        assert len(words) == greedy_words(ids)
        assert idfiles.unpack_block(words, escaped, len(ids)).tolist() == ids
    assert len(idfiles.pack_block(np.zeros(1200, np.uint64))[0]) == 10


def test_segments_round_trip():
    rng = np.random.default_rng(4)
    lengths = [0, 5, 70, 1, 0, 33]
    ids = rng.integers(0, 1 << 20, sum(lengths))
    made = [idfiles.write_segment(3, [None, 1, 2, 5, 6, 9], lengths, ids, block_ids=16)] * 2
    content = b"".join(m + b"\n" for m in made)
    for head, tables, words in idfiles.segments(content):
        assert head["file"] == 3 and head["null_docs"] == 1 and tables["doc_id"].tolist() == [0, 1, 2, 5, 6, 9]
        assert np.diff(tables["end"], prepend=0).tolist() == lengths
        assert idfiles.segment_ids(head, tables, words).tolist() == ids.tolist()
    with pytest.raises(ValueError, match="no segment starts"):
        list(idfiles.segments(content[8:]))


def texts():
    rng = random.Random(6)
    words = ["the", "Größe", "日本", "it's", "x1", "\n", "  ", "<|endoftext|>", "�", "é", " ", "don't,"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    return [None, "", " ", "a<|endoftext|>b", *made, "ab " * 50_000, "x" * 5000]


LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_librarys(monkeypatch):
    monkeypatch.setattr(idfiles, "PART_CHARS", 500)
    monkeypatch.setattr(idfiles, "CACHED_WORDS", 20)
    encode = idfiles.LibraryIds(PATH).encode
    for text in texts():
        assert np.frombuffer(encode(text), "<u4").tolist() == library_ids(text)


@pytest.mark.parametrize("segment_ids", [idfiles.SEGMENT_IDS, 300])
def test_files_give_all_documents_in_order(spark, monkeypatch, segment_ids):
    monkeypatch.setattr(idfiles, "SEGMENT_IDS", segment_ids)
    rows = [(i * 3 % 97 - 5, t, 1, "f", 2) for i, t in enumerate(texts())]
    rows += [rows[7]] * 5 + [(None, "no id", 0, "", 0), (None, None, 0, "", 0), (rows[9][0], "another text", 0, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` long, file string, ids int").repartition(4)
    folder = work_path(spark, "token-files")
    idfiles.write_token_files(docs, folder, PATH, end_id=7, files=5)
    found = sorted(idfiles.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in found] == sorted((r[0] is not None, r[0] or 0) for r in rows)
    expected = Counter((r[0], tuple(library_ids(r[1])) + (7,)) for r in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == expected
    start = 0
    for r in found:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    index = idfiles.file_index(spark, folder).orderBy("file").collect()
    assert sum(r.docs for r in index) == len(rows) and sum(r.ids for r in index) == start
    assert [r.start for r in index] == [sum(r.ids for r in index[:i]) for i in range(len(index))]


def test_no_documents_no_segments(spark):
    folder = work_path(spark, "token-files")
    idfiles.write_token_files(spark.createDataFrame([], "doc_id long, text string"), folder, PATH)
    assert idfiles.read_token_files(spark, folder).collect() == []


def test_query_reads_back_what_the_library_encodes(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    start, expected = 0, []
    for d in documents:
        ids = [*library_ids(d.text), 0]
        expected.append((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = queries.op12_token_files(spark, SF_DIR)
    assert sorted(map(tuple, found.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected


def test_ids_of_two_bytes_are_packed_without_a_search(monkeypatch):
    ids = np.array([0, 1, 255, 256, 40_000, 65_535, 3] * 50, np.uint64)
    expected = idfiles.pack_block(np.append(ids, np.uint64(1 << 40)))[0][:50].tolist()

    def searched(*args, **kwargs):
        raise AssertionError("searched")

    monkeypatch.setattr(idfiles.np, "searchsorted", searched)
    words, escaped = idfiles.pack_block(ids)
    assert words[:50].tolist() == expected and escaped == 0
    assert idfiles.unpack_block(words, escaped, len(ids)).tolist() == ids.tolist()


def test_each_distinct_word_is_looked_up_once(monkeypatch):
    library = Tokenizer.from_file(PATH)
    calls = []

    class Model:
        def __getattr__(self, name):
            return getattr(library.model, name)

        def tokenize(self, symbols):
            calls.append(symbols)
            return library.model.tokenize(symbols)

    class Library:
        model = Model()

        def __getattr__(self, name):
            return getattr(library, name)

    monkeypatch.setattr("tokenizers.Tokenizer.from_file", lambda path: Library())
    words = [f"{a}{b}" for a in "abcdefghijklmnop" for b in "qrstuvwxyz"]
    text = " ".join(words * 20)
    assert np.frombuffer(idfiles.LibraryIds(PATH).encode(text), "<u4").tolist() == library_ids(text)
    assert 0 < len(calls) < len(words) / 8 and sum(map(len, calls)) < 2 * len(" ".join(words))


MIXED = st.text(st.sampled_from("aslrvetmdZé日é1²৩Ⅷ'’\"!_ \u00a0\u3000\u2028\n\r\t\x1c\x85\0😀𝔸ÿ"), max_size=40)


@given(st.lists(st.one_of(MIXED, st.text(max_size=20)), min_size=1, max_size=5))
@settings(max_examples=400, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    points = np.array([ord(c) for t in texts for c in t + "\0"], np.uint32)
    marks = np.cumsum([len(t) + 1 for t in texts]) - 1
    expected = np.cumsum([0] + [len(w) for t in texts for w in [*regex.findall(bpe.SPLIT, t), "\0"]])[:-1]
    assert np.flatnonzero(idfiles.word_starts(points, marks)).tolist() == expected.tolist()


def test_many_texts_and_single_words_have_the_same_ids(monkeypatch):
    rng = random.Random(8)
    odd = ["it's", "'re", "''s", " 's", "x'lly", "\n's", "\0", "ÿ", "\x1c", "  \n x", "²", "\u3000a", "😀😀", "<|endoftext|>", "zürich"]
    mixed = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 12))) for _ in range(300)] + texts()
    expected = [library_ids(t) for t in mixed]
    for part_chars, cached, between in ((1_000_000, 300_000, True), (40, 5, True), (200, 300_000, False)):
        monkeypatch.setattr(idfiles, "PART_CHARS", part_chars)
        monkeypatch.setattr(idfiles, "CACHED_WORDS", cached)
        library = idfiles.LibraryIds(PATH)
        assert library._between is not None
        library._between = library._between if between else None
        assert [np.frombuffer(ids, "<u4").tolist() for ids in library.encode_many(mixed)] == expected
    assert np.frombuffer(library.encode(None), "<u4").tolist() == [] and list(library.encode_many([])) == []
