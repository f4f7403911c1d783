"""Token files, centroid search and spelling variants against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from boletim.llm import bitpack, centroids, spelling
from boletim.llm.common import tokenizer_file

TEXTS = [
    None, "", " ", "   ", "one", "a  b \n c\t d", "é日本 <|endoftext|> ▁ x  ", "same text", "same text",
    "word " * 40_000, "x" * 3000, "0\x00\x1c'll \x85 ²½ İ", "\n \nindented\n    code\n", "it's we'll",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))


def _frame(spark):
    ids = [3, None, 9, -4, 7, 7, 8, 8, 8, 30, 31, 2**60, 1, 0]
    rows = [(i, t, "clash", 5) for i, t in zip(ids, TEXTS)]
    rows += [rows[7]] * 3 + [(None, "null id", "clash", 5)]
    return rows, spark.createDataFrame(
        rows, "doc_id bigint, text string, start string, ids_crc32 int"
    ).repartition(3)


def test_files_hold_what_the_library_gives(spark, library, tmp_path):
    rows, docs = _frame(spark)
    folder = str(tmp_path / "ids")
    manifest = bitpack.write(docs, folder, block=512)
    got = bitpack.read(spark, folder, with_ids=True).collect()
    want = Counter()
    for doc, text, *_ in rows:
        ids = (*library.encode(text or "", add_special_tokens=False).ids, 2)
        want[doc, ids] += 1
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    got.sort(key=lambda r: r.start)
    keys = [-(2**63) if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    ends = [r.start + r.n_tokens for r in got]
    assert [r.start for r in got] == [0, *ends[:-1]] and ends[-1] == manifest.agg({"ids": "sum"}).first()[0]
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    plain = bitpack.read(spark, folder)
    assert plain.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r[:4]) for r in got if r.doc_id) == sorted(
        tuple(r) for r in plain.collect() if r.doc_id
    )


def test_documents_of_one_key_may_fill_many_files(spark, tmp_path, conf):
    conf(
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="5",
    )
    docs = spark.range(400).selectExpr("7L AS doc_id", "concat('t', id % 3) AS text")
    manifest = bitpack.write(docs, str(tmp_path / "ids"))
    assert manifest.count() > 1
    got = sorted(bitpack.read(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    ends = [r.start + r.n_tokens for r in got]
    assert len(got) == 400 and [r.start for r in got] == [0, *ends[:-1]]
    # Equal texts stand together, wherever a file ends.
    crcs = [r.ids_crc32 for r in got]
    assert sum(a != b for a, b in zip(crcs, crcs[1:])) == 2


def test_files_outside_the_manifest_are_not_read(spark, tmp_path):
    _, docs = _frame(spark)
    folder = tmp_path / "ids"
    bitpack.write(docs, str(folder))
    one = next(folder.glob("*.bin"))
    (folder / "ids-0000000-lost.bin").write_bytes(one.read_bytes()[:100])
    assert bitpack.read(spark, str(folder)).count() == docs.count()
    empty = str(tmp_path / "none")
    assert bitpack.write(docs.limit(0), empty).count() == 0
    assert bitpack.read(spark, empty).count() == 0


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=60), st.data())
def test_ids_pack_and_unpack(bits, ids, data):
    ids = np.array([i % (1 << bits) for i in ids], "<u4")
    packed = bitpack.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    first = data.draw(st.integers(0, len(ids)))
    count = data.draw(st.integers(0, len(ids) - first))
    assert (bitpack.unpack(packed, first, count, bits) == ids[first : first + count]).all()


def test_any_stretch_of_a_file(tmp_path):
    rng = np.random.default_rng(0)
    for bits, lengths in ((16, [5, 0, 70, 1, 33]), (17, [64, 64]), (3, []), (1, [1])):
        docs = [rng.integers(0, 1 << bits, n, dtype="uint32") for n in lengths]
        out = io.BytesIO()
        writer = bitpack.Writer(out, bits, block=32)
        writer.add([str(i) for i in range(len(docs))], docs)
        writer.close()
        reader = bitpack.Reader(out)
        whole = np.concatenate([np.zeros(0, "uint32"), *docs])
        assert reader.n_ids == len(whole)
        for _ in range(50):
            a, b = sorted(rng.integers(0, len(whole) + 1, 2))
            assert (reader.ids(int(a), int(b - a)) == whole[a:b]).all()
        found = list(reader.documents(at_once=40))
        assert [k for k, _, _ in found] == [str(i) for i in range(len(docs))]
        assert all((ids == doc).all() for (_, _, ids), doc in zip(found, docs))
        with pytest.raises(IndexError):
            reader.ids(0, len(whole) + 1)
        with pytest.raises(ValueError):
            bitpack.Reader(io.BytesIO(out.getvalue()[:-9] + b"x" * 9))
    with pytest.raises(ValueError):
        bitpack.Writer(io.BytesIO(), 3).add(["a"], [np.array([8], "uint32")])


def test_byte_encoder_on_random_text(library):
    encoder = bitpack.ByteEncoder(tokenizer_file("byte_bpe_50k.json"))
    rng = random.Random(7)
    parts = [" ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "a", "'s", "é", "日", "12", "!", "<|", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)]
    assert [x.tolist() for x in encoder.encode(texts)] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)
    ]


def test_fewest_bits():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def _lloyd(rows, count, rounds, dimension):
    """Plain rounds in Python's integers."""
    kept = []
    for key, v in rows:
        if v is not None and len(v) == dimension and all(x is not None and np.isfinite(x) for x in v):
            kept.append((key, [int(np.floor(float(np.float32(x)) * 256)) for x in v], [float(np.float32(x)) for x in v]))

    def drawn(row):
        name = "" if row[0] is None else str(row[0])
        return hashlib.sha256(f"2:{name}".encode()).hexdigest(), row[2]

    made = [r[1] for r in sorted(kept, key=drawn)[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(made))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v, _ in kept]
        made = [
            [sum(x) // len(x) for x in zip(*mine)] if mine else old
            for old, mine in ((m, [v for (_, v, _), f in zip(kept, found) if f == c]) for c, m in enumerate(made))
        ]
    out = [(key, *reversed(nearest(v))) for key, v, _ in kept]
    inertia = Counter()
    for _, c, d in out:
        inertia[c] += d
    total = sum(inertia.values())

    def fits(x):
        return x if x < 2**63 else None

    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in made]
    whole = all(fits(d) is not None for _, _, d in out)
    return [
        (k, c, fits(d), fits(inertia[c]), fits(total) if whole else None, digest[c]) for k, c, d in out
    ]


@pytest.mark.parametrize("scale, far", [(0.2, 0), (300.0, 0), (30_000.0, 0), (0.2, 1e30)])
def test_clusters(spark, scale, far):
    rng = np.random.default_rng(5)
    middles = rng.normal(0, scale, (6, 8))
    rows = [(i, [float(x) for x in middles[i % 6] + rng.normal(0, scale / 4, 8)]) for i in range(150)]
    rows += [rows[3], rows[3], (3, rows[9][1]), (None, rows[4][1]), (None, rows[5][1])]
    rows += [(200, [0.0] * 8), (201, [-0.001] * 8)] + ([(300, [far] * 8)] if far else [])
    bad = [(400, None), (401, []), (402, [1.0] * 7), (403, [None] + [1.0] * 7)]
    bad += [(404, [float("nan")] * 8), (405, [float("inf")] * 8)]
    schema = "vec_id bigint, embedding array<float>, cluster string"
    df = spark.createDataFrame([(*r, "clash") for r in rows + bad], schema).repartition(3)
    got = centroids.cluster(df, count=12, rounds=3, dimension=8)
    if far:  # sums that hold a distance beyond 63 bits are null
        want = [(k, c, d) for k, c, d, *_ in _lloyd(rows, 12, 3, 8)]
        found = got.collect()
        assert sorted(map(str, (r[:3] for r in map(tuple, found)))) == sorted(map(str, want))
        assert {r.centroid_sha256 for r in found} == {r[5] for r in _lloyd(rows, 12, 3, 8)}
    else:
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, _lloyd(rows, 12, 3, 8)))


def test_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<double>"
    two = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 2.0])], schema)
    got = centroids.cluster(two, count=5, dimension=2).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in got) == [(1, 0, 0), (2, 0, 0)]
    assert centroids.cluster(two.limit(0), dimension=2).count() == 0
    huge = spark.createDataFrame([(1, [1e308, 1.0]), (2, [1e308, 1.0])], schema)
    assert [r.distance for r in centroids.cluster(huge, count=1, dimension=2).collect()] == [0, 0]


def test_search_rejects_without_losing(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(0, 3, (20, 1)) + rng.normal(0, 0.3, (20, 16))
    rows = centroids.scaled(np.repeat(middles, 50, axis=0) + rng.normal(0, 0.2, (1000, 16)))
    made = [[int(x) for x in r] for r in rows[::25]] + [[int(x) for x in rows[0]]]
    number, best, computed = centroids.Search(made).nearest(rows)
    distances = ((rows[:, None, :] - np.array(made)[None]) ** 2).sum(axis=2)
    assert (number == distances.argmin(axis=1)).all() and (best == distances.min(axis=1)).all()
    assert computed < len(rows) * len(made) / 3


def _variants(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n]


def _spelling_rows():
    rng = random.Random(8)
    rows = []
    for base in ("planeta", "çãÿ÷ção", "maremoto", "aaaaaaa", "x" * 300):
        words = [base]
        for _ in range(14):
            w, at = rng.choice(words), rng.randrange(len(base) - 1)
            letter = rng.choice("abyzé×")
            words.append(rng.choice([w[:at] + w[at + 1 :], w[:at] + letter + w[at:], w[:at] + letter + w[at + 1 :]]))
        for k, w in enumerate(words):
            for _ in range(rng.choice([4, 5, 6, 25, 130]) if k else 700):
                rows.append((rng.randrange(500), rng.choice([w, w.title() if w.isascii() else w])))
    rows += [(900 + i, "Étage étage ÉTAGEZ Maremoto1maremoto-maremotos") for i in range(9)]
    rows += [(None, "planeta"), (None, None), (7, ""), (7, "a b 12 "), (8, "planeta " * 3000)]
    rng.shuffle(rows)
    return rows


def test_variants(spark, monkeypatch):
    rows = _spelling_rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    want = sorted(map(str, _variants(rows)))
    assert sum("None" not in x for x in want) > 10
    got = spelling.variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(str, map(tuple, got.collect()))) == want
    # Many parts of a block, and other groups of letters, change nothing.
    monkeypatch.setattr(spelling, "BLOCK_LETTERS", 40)
    monkeypatch.setattr(spelling, "groups_for", lambda words: 4)
    assert sorted(map(str, map(tuple, spelling.variants(df).collect()))) == want
    assert spelling.variants(df.limit(0)).count() == 0


def test_chains_of_forms_end_at_their_root(spark, tmp_path):
    names = ["a", "b", "c", "d", "e", "f", "g"]
    forms = spark.createDataFrame(
        [(w, f) for w, f in zip(names, [*names[1:], None])] + [("z", "g"), ("y", None)],
        "word string, form string",
    )
    got = spelling._roots(forms, 5 * 5**6, str(tmp_path / "r"), 5, 5).collect()
    assert {(r.word, r.root) for r in got} == {(w, "g") for w in [*names[:-1], "z"]}


def test_edits_are_told_apart():
    words = ["abcdef", "abcdeg", "abcdeff", "bacdef", "abcdefg", "xabcdef", "abccdef", "abcde", "gedcba"]
    by = {}
    for w in words:
        by.setdefault(len(w), []).append(w)
    found = set()
    for length, some in by.items():
        x = spelling.Block(some, [1] * len(some))
        for other in (x, spelling.Block(by[length + 1], [1] * len(by[length + 1])) if length + 1 in by else None):
            if other is not None:
                i, j = spelling.near_pairs(x, other)
                found |= {frozenset((x.words[a], other.words[b])) for a, b in zip(i, j)}
    assert found == {frozenset(p) for p in (
        ("abcdef", "abcdeg"), ("abcdef", "abcdeff"), ("abcdef", "abcdefg"), ("abcdef", "xabcdef"),
        ("abcdef", "abccdef"), ("abcde", "abcdef"), ("abcde", "abcdeg"), ("abcdeg", "abcdefg"),
        ("abcdeff", "abcdefg"),
    )}
