"""The toxicity models against a plain version, and the whole pipeline against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from boletim.llm import toxicity
from boletim.llm.common import tokenizer_file
from tests.llm.test_joins import _components, _shingles

BAD = ["grobian", "lump", "schuft", "wicht"]


def _corpus(rng, documents):
    words = ["".join(rng.choices("abcdeoé", k=rng.randint(2, 5))) for _ in range(220)]
    texts, toxic = [], []
    for i in range(documents):
        text = rng.choices(words, k=rng.randint(15, 70))
        bad = i % 6 == 0
        for _ in range(rng.randint(3, 6) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        if i % 3 == 0:
            text.insert(5, "Es war,")
        texts.append(" ".join(text).capitalize() + ".")
        toxic.append(bad)
    return texts, toxic


def _plain_values(rows):
    """Word and bigram values by the formulas, from ``(text, toxic)``."""
    pairs = {False: Counter(), True: Counter()}
    for text, bad in rows:
        words = re.findall(r"\w+", text.lower())
        pairs[bad].update(set(zip(["\x02", *words], words)))
    follow = {y: Counter(w for _, w in pairs[y]) for y in pairs}

    def smoothing(counts):
        total = {y: sum(counts[y].values()) for y in counts}
        small = min((True, False), key=lambda y: total[y])
        n = Counter(counts[small].values())
        base = 2.0
        if n[1] and n[2] and n[3]:
            base = max(0.5, 3 - 4 * n[1] / (n[1] + 2 * n[2]) * n[4] / n[3])
        discount = {y: base * total[y] / total[small] for y in counts}
        freed = sum(sum(min(c, discount[y]) for c in counts[y].values()) / total[y] for y in counts) / 2
        return total, discount, freed

    def cut(x):
        return math.copysign(max(abs(x) - toxicity.SLACK, 0), x)

    total, discount, freed = smoothing(follow)
    lower = {
        w: {
            y: max(follow[y][w] - discount[y], 0) / total[y]
            + freed * sum(follow[z][w] / total[z] for z in pairs) / 2
            for y in pairs
        }
        for w in {*follow[True], *follow[False]}
    }
    word = {w: cut(math.log(x[True] / x[False])) for w, x in lower.items()}
    total, discount, _ = smoothing(pairs)
    own = {}
    context = {y: Counter() for y in pairs}
    left = {y: Counter() for y in pairs}
    for y in pairs:
        for (v, _), c in pairs[y].items():
            context[y][v] += c / total[y]
            left[y][v] += min(c, discount[y]) / total[y]
    for v, w in {*pairs[True], *pairs[False]}:
        if any(pairs[y][v, w] >= toxicity.STABLE * discount[y] for y in pairs):
            rate = max(context[y][v] for y in pairs)
            back = max(sum(left[y][v] for y in pairs) / 2 / rate, toxicity.LEAST_BACKOFF)
            p = {
                y: max(pairs[y][v, w] - discount[y], 0) / total[y] / rate + back * lower[w][y]
                for y in pairs
            }
            own[v, w] = cut(math.log(p[True] / p[False]))
    return word, own


def test_models_equal_the_plain_ones(spark, tmp_path):
    rng = random.Random(12)
    texts, toxic = _corpus(rng, 400)
    rows = [(rng.choice(toxicity.FOLDS), bad, 1.0, text) for text, bad in zip(texts, toxic)]
    sample = spark.createDataFrame(rows, "fold int, toxic boolean, weight double, text string")
    toxicity.bigram_counts(sample).write.parquet(str(tmp_path / "counts"))
    counts = spark.read.parquet(str(tmp_path / "counts"))
    others = ["", " . ", "lump", "Lump! schuft unknown", "Es war, " * 3, "é" * 50, *texts[:50], "x " * 40_000]
    for folds in (toxicity.FOLDS, toxicity.FOLDS[:2]):
        model = toxicity.build(counts, folds)
        word, own = _plain_values([(t, bad) for f, bad, _, t in rows if f in folds])
        assert any(own.values()) and any(word.values())
        want = []
        for text in others:
            words = re.findall(r"\w+", text.lower())
            values = [own.get(p, word.get(p[1], 0.0)) for p in zip(["\x02", *words], words)]
            want.append(sum(values) / max(len(values), 1))
        assert model.per_word(others) == pytest.approx(want, abs=1e-5)


def _write_tables(spark, folder, documents, labels):
    documents.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")


def test_pipeline_equals_plain_python(spark, tmp_path):
    rng = random.Random(13)
    texts, toxic = _corpus(rng, 300)
    rows = [(i, t, "xx", ["b", None, "a"][i % 3], len(t)) for i, t in enumerate(texts)]
    for i in range(40):  # copies and near copies of ordinary documents, over other sources
        base = texts[6 * i + 1]
        rows.append((1000 + i, base.replace("e", "E", 1) if i % 2 else base + " end", "xx", "c", 1))
    rows += [rows[1], (2000, None, "xx", "a", 0), (2001, "", None, None, 0), (2002, "w " * 5000, "xx", "c", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame(
        [(i, 1, int(bad)) for i, bad in enumerate(toxic)], "doc_id bigint, quality int, toxic int"
    )
    folder = str(tmp_path / "tables")
    _write_tables(spark, folder, docs, labels)

    # The models have a test of their own; here their decisions must take effect.
    judged = {(r.doc_id, r.text): r.predicted for r in toxicity.judge(docs, labels).collect()}
    caught = sum(judged[i, t] for i, t in enumerate(texts) if toxic[i])
    assert caught >= 0.9 * sum(toxic) and sum(judged.values()) <= 1.3 * sum(toxic)
    kept = [r for r in rows if not judged[r[0], r[1]]]

    sets = [_shingles(r[1] or "") for r in kept]
    groups, one = {}, []
    for r, s, c in zip(kept, sets, _components(sets)):
        if s:
            groups.setdefault(c, []).append(r)
        else:
            one.append(r)
    one += [min(g) if len({x[0] for x in g}) > 1 else g[0] for g in groups.values()]
    assert len(one) < len(kept)

    size = {id(r): len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in one}
    per = Counter()
    for r in one:
        per[r[3]] += size[id(r)]
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), 1.5 * sum(per.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * per[s]}
        for s in full or open_:
            target[s] = 2 * per[s] if full else level * weight[s]
        rest -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = Counter()
    for r in one:
        rate = target[r[3]] / per[r[3]] if per[r[3]] else 1.0
        toss = int(hashlib.md5(f"mix:{r[0]}:{r[1] or ''}".encode()).hexdigest()[:13], 16) / 2**52
        ids = np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            cell = (r[0], piece, at, len(part), zlib.crc32(part.tobytes()))
            want[cell] += math.floor(rate) + (toss < rate - math.floor(rate))

    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == +want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(bins) <= 1.02 * sum(r.length for r in got) / 2048 + 1
