"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A paragraph is a line or, where a line has several sentences, each of them; it goes by the 64-bit
hash of its text and of how many equal ones came before it. A sketch has ``CELLS`` cells, each with
the number, the XOR of digests and the XOR of check hashes of the paragraphs that fall into it; each
paragraph falls into one cell of each quarter. Two versions' sketches are subtracted cell by cell,
which cancels what they share, and cells with one paragraph left are peeled until nothing is left:
that recovers the digests that differ. Where peeling fails, a larger sketch is tried, in sections
that the paragraphs are dealt to by hash, about ``LOAD`` to each; a section that fails again is dealt
to four more with another hash, up to ``RETRIES`` times. The last resort, for chance collisions in
each of them, is to compare the digests of that section.

All of it is row-wise array expressions, so no paragraph is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boletim.llm.common import whole_text

CELLS = 32
#: Where a sketch fails, paragraphs are dealt to sketches of so many cells, about so many to each.
DEALT_CELLS, LOAD = 16, 4
RETRIES = 3
#: Rounds of peeling at most; each takes every cell that has one paragraph.
ROUNDS = 12
#: Where paragraphs end: at line ends and after sentences.
ENDS = r"\n+|(?<=[.!?|])\s+"
#: Ranges of ids that texts are ordered in, for each shuffle partition.
RANGES_PER_PARTITION = 4

_NONE = "array<struct<x:bigint,s:int>>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digests(text: Column) -> Column:
    """The sorted digests of a text's paragraphs; blank ones are none."""
    parts = F.filter(F.split(text, ENDS), lambda p: F.trim(p) != "")
    hashes = F.array_sort(F.transform(parts, lambda p: F.xxhash64(p)))

    def numbered(found: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(found) - 1)
        first = lambda i: (i == 0) | (F.get(found, i) != F.get(found, i - 1))
        starts = F.when(F.size(found) > 0, F.filter(places, first)).otherwise(
            F.array().cast("array<int>")
        )

        def runs(at: Column) -> Column:
            def run(start: Column, k: Column) -> Column:
                end = F.coalesce(F.get(at, k + 1), F.size(found))
                return F.transform(
                    F.sequence(F.lit(0), end - start - 1),
                    lambda n: F.xxhash64(F.get(found, start), n),
                )

            return F.flatten(F.transform(at, run))

        return _let(starts, runs)

    return _let(hashes, numbered)


def _check(x: Column) -> Column:
    return F.xxhash64(x, F.lit("check"))


def _mask(x: Column, seed: int, count: int) -> Column:
    """The cells of a digest, as bits: one in each quarter."""
    quarter = count // 4

    def bits(h: Column) -> Column:
        mask = F.lit(0).cast("bigint")
        for q in range(4):
            place = F.shiftrightunsigned(h, 8 * q).bitwiseAND(F.lit(quarter - 1)).cast("int")
            mask = mask.bitwiseOR(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), place + q * quarter)
            )
        return mask

    return _let(F.xxhash64(x, F.lit(seed)), bits)


def cells(found: Column, seed: int = 0, count: int = CELLS) -> Column:
    """The sketch of an array of digests: ``n`` (count), ``x`` (digests), ``c`` (check hashes)."""
    items = F.transform(
        found,
        lambda x: F.struct(x.alias("x"), _mask(x, seed, count).alias("m"), _check(x).alias("c")),
    )
    empty = F.struct(
        F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("c")
    )

    def cell(of: Column):
        return lambda j: F.aggregate(
            F.filter(of, lambda i: F.getbit(i["m"], j) == 1),
            empty,
            lambda a, i: F.struct(
                (a["n"] + 1).alias("n"),
                a["x"].bitwiseXOR(i["x"]).alias("x"),
                a["c"].bitwiseXOR(i["c"]).alias("c"),
            ),
        )

    places = F.sequence(F.lit(0), F.lit(count - 1))
    return _let(items, lambda of: F.transform(places, cell(of)))


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.struct(
        (a["n"] - b["n"]).alias("n"),
        a["x"].bitwiseXOR(b["x"]).alias("x"),
        a["c"].bitwiseXOR(b["c"]).alias("c"),
    ))


def peel(difference: Column, seed: int = 0, count: int = CELLS) -> Column:
    """``got``, the digests recovered with the sign of their side, and ``ok``, whether all were."""
    start = F.struct(
        difference.alias("cells"), F.array().cast(_NONE).alias("got"), F.lit(False).alias("stuck")
    )

    def single(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (c["c"] == _check(c["x"]))

    def step(state: Column, _: Column) -> Column:
        pure = F.array_distinct(F.transform(
            F.filter(state["cells"], single),
            lambda c: F.struct(c["x"].alias("x"), c["n"].alias("s"), c["c"].alias("c"),
                               _mask(c["x"], seed, count).alias("m")),
        ))

        def without(taken: Column) -> Column:
            left = F.transform(state["cells"], lambda c, j: F.aggregate(
                F.filter(taken, lambda p: F.getbit(p["m"], j) == 1),
                c,
                lambda a, p: F.struct(
                    (a["n"] - p["s"]).alias("n"),
                    a["x"].bitwiseXOR(p["x"]).alias("x"),
                    a["c"].bitwiseXOR(p["c"]).alias("c"),
                ),
            ))
            got = F.concat(
                state["got"],
                F.transform(taken, lambda p: F.struct(p["x"].alias("x"), p["s"].alias("s"))),
            )
            return F.when(
                F.size(taken) > 0,
                F.struct(left.alias("cells"), got.alias("got"), F.lit(False).alias("stuck")),
            ).otherwise(
                F.struct(state["cells"].alias("cells"), state["got"].alias("got"),
                         F.lit(True).alias("stuck"))
            )

        return F.when(state["stuck"], state).otherwise(_let(pure, without))

    def end(state: Column) -> Column:
        clear = F.forall(state["cells"], lambda c: (c["n"] == 0) & (c["x"] == 0) & (c["c"] == 0))
        return F.struct(state["got"].alias("got"), clear.alias("ok"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, end)


def _compared(left: Column, right: Column) -> Column:
    """The same as peeling gives, from the digests themselves."""
    side = lambda a, b, s: F.transform(
        F.array_except(a, b), lambda x: F.struct(x.alias("x"), F.lit(s).alias("s"))
    )
    return F.concat(side(left, right, 1), side(right, left, -1))


def _dealt(left: Column, right: Column, parts: Column, seed: int) -> Column:
    """``parts`` pairs ``l, r`` of the digests of both sides, dealt by their hash."""
    def share(of: Column, b: Column) -> Column:
        return F.filter(of, lambda x: F.pmod(F.xxhash64(x, F.lit(-seed)), parts) == b)

    return F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda b: F.struct(share(left, b).alias("l"), share(right, b).alias("r")),
    )


def _parts(pair: Column) -> Column:
    """Sketches that a pair of digest arrays needs."""
    return F.greatest(F.ceil((F.size(pair["l"]) + F.size(pair["r"])) / LOAD), F.lit(1)).cast("int")


def with_difference(rows: DataFrame, name: str, left: str, right: str) -> DataFrame:
    """Adds ``name``: the digests in one version only, ``x``, and ``s`` 1 (left) or -1 (right).

    ``left`` and ``right`` name structs of a version's digests ``d`` and sketch ``s``. The sketches
    are tried first, larger ones are made of the digests where that fails. The digests are dealt in
    two steps, so that the work grows little faster than the paragraphs.
    """
    c = F.col
    tried, pairs, peeled = f"{name}_tried", f"{name}_pairs", f"{name}_peeled"
    none = F.array().cast("array<struct<l:array<bigint>,r:array<bigint>>>")
    whole = F.struct(c(left)["d"].alias("l"), c(right)["d"].alias("r"))
    outer = F.ceil(F.sqrt(_parts(whole))).cast("int")
    rows = (
        rows.withColumn(tried, peel(subtract(c(left)["s"], c(right)["s"])))
        .withColumn(name, F.when(c(tried)["ok"], c(tried)["got"]).otherwise(F.array().cast(_NONE)))
        .withColumn(
            pairs, F.when(c(tried)["ok"], none).otherwise(_dealt(whole["l"], whole["r"], outer, 1))
        )
        .withColumn(
            pairs, F.flatten(F.transform(pairs, lambda p: _dealt(p["l"], p["r"], _parts(p), 2)))
        )
    )
    for seed in range(3, 4 + RETRIES):
        sketch = partial(cells, seed=seed, count=DEALT_CELLS)
        result = lambda p: peel(
            subtract(sketch(p["l"]), sketch(p["r"])), seed, DEALT_CELLS  # noqa: B023
        )
        rows = (
            rows.withColumn(peeled, F.transform(pairs, lambda p: F.struct(
                p["l"].alias("l"), p["r"].alias("r"), result(p).alias("p")  # noqa: B023
            )))
            .withColumn(name, F.concat(name, F.flatten(F.transform(
                F.filter(peeled, lambda p: p["p"]["ok"]), lambda p: p["p"]["got"]
            ))))
            .withColumn(pairs, F.flatten(F.transform(
                F.filter(peeled, lambda p: ~p["p"]["ok"]),
                lambda p: _dealt(p["l"], p["r"], F.lit(4), seed),  # noqa: B023
            )))
        )
    rest = F.flatten(F.transform(pairs, lambda p: _compared(p["l"], p["r"])))
    return rows.withColumn(name, F.concat(name, rest)).drop(tried, pairs, peeled)


def likeness(left: Column, right: Column, difference: Column) -> Column:
    """Shared paragraphs as a part of all, from 0 to 1; two texts without paragraphs are alike."""
    total = F.size(left) + F.size(right)
    return F.when(total == 0, 1.0).otherwise(
        _let(F.size(difference), lambda apart: (total - apart) / (total + apart))
    )


def text_of(sketch: Column) -> Column:
    """A sketch as text: count, digests and checks of each cell in hexadecimal; empty cells blank."""
    cell = lambda c: F.when((c["n"] == 0) & (c["x"] == 0), "").otherwise(
        F.concat_ws(".", F.hex(c["n"]), F.hex(c["x"]), F.hex(c["c"]))
    )
    return F.concat_ws(",", F.transform(sketch, cell))


def _range_starts(docs: DataFrame, key: str) -> list:
    """Keys that cut the documents into even ranges; the first is the smallest."""
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION
    shares = [i / count for i in range(count)]
    row = docs.agg(
        F.min(key).alias("first"),
        F.percentile_approx(key, shares, max(10_000, 10 * count)).alias("starts"),
    ).first()
    return sorted({row["first"], *(row["starts"] or ())} - {None})


def _range_of(key: Column, starts: list) -> Column:
    """The number of the range that a key falls into, found in two steps; null keys are in 0."""
    width = max(int(len(starts) ** 0.5), 1)
    groups = [starts[i : i + width] for i in range(0, len(starts), width)]
    array = lambda of: F.array(*map(F.lit, of))
    below = lambda of: F.size(F.filter(of, lambda s: s <= key))
    group = F.greatest(below(array([g[0] for g in groups])) - 1, F.lit(0))
    inner = F.get(F.array(*map(array, groups)), group)
    return F.coalesce(F.greatest(group * width + below(inner) - 1, F.lit(0)), F.lit(0))


def with_next(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    about: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``key, text, next``: every text with the text of the next key, the last with the first's.
    With ``about``, what that makes of both texts too, ``v_text`` and ``v_next``, once per text.

    Null keys come first, equal keys are ordered by their text. The texts are dealt once, into even
    ranges of keys; the first row of a range goes to the range before it as well.
    """
    plain = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    starts = _range_starts(plain, "key") or [0]
    column = F.col("key")
    at = _range_of(column, starts)
    begins = F.array(*map(F.lit, starts))
    nulls = plain.where("key IS NULL").limit(1).count() > 0
    leads = (F.get(begins, at) == column) & (F.lit(not nulls) | (at > 0)) | column.isNull()
    home = F.struct(at.alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(
        F.pmod(at - 1, F.lit(len(starts))).alias("range"), F.lit(True).alias("guest")
    )
    dealt = plain.select(
        "key", "text",
        F.explode(F.when(leads, F.array(home, guest)).otherwise(F.array(home))).alias("at"),
    ).select("key", "text", "at.*")
    order = Window.partitionBy("range").orderBy(
        "guest", F.col("key").asc_nulls_first(), "text"
    )
    rows = dealt.repartition("range")
    columns = []
    if about is not None:
        rows = rows.withColumn("v_text", about(F.col("text")))
        columns = [F.col("v_text"), F.lead("v_text").over(order).alias("v_next")]
    following = F.lead("text").over(order).alias("next")
    return rows.select("guest", F.col("key").alias(key), "text", following, *columns).where(
        "NOT guest"
    ).drop("guest")


def edited(text: Column, other: Column) -> Column:
    """The text with its last quarter of code points replaced by as many of another's first."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - quarter),
        F.substring(other, F.lit(1), quarter),
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's sketch, that of its edited text, and how near it is to that and to the next.

    A null text counts as empty and has an empty sketch. Equal texts have equal sketches. Null keys
    come first, and rows of one key in the order of their texts; repeated rows follow each other. An
    empty table gives no rows, and other columns are not read.
    """
    sketched = lambda t: _let(
        digests(t), lambda d: F.struct(d.alias("d"), cells(d).alias("s"))
    )
    rows = with_next(docs, key, text, sketched)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next")))
    rows = rows.withColumn("v_edited", sketched(F.col("edited")))
    rows = rows.select(
        key,
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "v_text", "v_edited", "v_next",
    )
    for name in ("edited", "next"):
        rows = with_difference(rows, f"apart_{name}", "v_text", f"v_{name}")
    near = [
        likeness(
            F.col("v_text")["d"], F.col(f"v_{name}")["d"], F.col(f"apart_{name}")
        ).alias(f"near_{name}")
        for name in ("edited", "next")
    ]
    return rows.select(
        key, "n_chars", "edited_sha256",
        text_of(F.col("v_text")["s"]).alias("fingerprint"),
        text_of(F.col("v_edited")["s"]).alias("edited_fingerprint"),
        *near,
    )
