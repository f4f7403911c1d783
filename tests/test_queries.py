"""The named questions: fixed rows in fixed order, edges, and brute force over awkward data."""

from __future__ import annotations

import math
import random
import statistics
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from boletim.plans.queries import NAMED_QUERIES, media_global
from tests.data import golden, make_warehouse, rows

GOLDEN = {
    "media_por_escola": [
        ("E2", "Escola Dois", "privada", "Norte", 2, 1, 9.0, 9.0, 9.0, None),
        ("E1", "Escola Um", "pública", "Norte", 2, 3, 6.67, 5.0, 8.0, 1.53),
        ("E3", "Escola Três", "privada", "Sul", 0, 0, None, None, None, None),
    ],
    "media_por_regiao": [
        ("Norte", 2, 4, 4, 7.25, 5.0, 9.0),
        ("Sul", 1, 0, 0, None, None, None),
    ],
    "ranking_escolas_regiao": [
        ("Norte", "Escola Dois", "privada", 9.0, 1, 7.83),
        ("Norte", "Escola Um", "pública", 6.67, 2, 7.83),
        ("Sul", "Escola Três", "privada", None, 1, None),
    ],
    "comparacao_redes": [
        ("privada", 2, 2, 1, 9.0, None, 9.0, 9.0, 9.0),
        ("pública", 1, 2, 3, 6.67, 1.53, 5.0, 8.0, 7.0),
    ],
    "rede_por_regiao": [
        ("Norte", "privada", 1, 2, 9.0),
        ("Norte", "pública", 1, 2, 6.67),
        ("Sul", "privada", 1, 0, None),
    ],
    "estatisticas_disciplina": [
        ("Português", 1, 1, 8.0, None, 8.0, 8.0, 8.0, 8.0, 8.0),
        ("Matemática", 3, 3, 7.0, 2.0, 5.0, 9.0, 6.0, 7.0, 8.0),
    ],
    "histograma_disciplina": [
        ("Português", 0, 0, 0, 0, 1, 1, 8.0),
        ("Matemática", 0, 0, 1, 1, 1, 3, 7.0),
    ],
    "ranking_disciplinas": [
        ("Português", 8.0, 1, "Excelente"),
        ("Matemática", 7.0, 2, "Excelente"),
    ],
    "disciplina_por_rede": [
        ("Matemática", "privada", 1, 9.0, None),
        ("Matemática", "pública", 2, 6.0, 1.41),
        ("Português", "pública", 1, 8.0, None),
    ],
}


@pytest.mark.parametrize("name", GOLDEN)
def test_golden_rows_in_order(spark, name):
    assert rows(NAMED_QUERIES[name](golden(spark))) == GOLDEN[name]


def test_every_named_query_is_covered():
    assert set(GOLDEN) == set(NAMED_QUERIES)


def test_media_global(spark):
    assert rows(media_global(golden(spark))) == [(4, 7.25)]


def test_band_and_label_edges(spark):
    grades = [0, 1.9, 2, 3.9, 4, 5.9, 6, 7.9, 8, 10]
    notas = [(f"A{i}", "D", g) for i, g in enumerate(grades)]
    means = {"sete": [7], "seis": [6], "cinco": [5], "quase": [7] * 99 + [6.9], "menos": [4.9]}
    notas += [(f"{d}{i}", d, g) for d, gs in means.items() for i, g in enumerate(gs)]
    w = make_warehouse(spark, [], [], [*notas, ("Z", "vazia", None)])
    counted = NAMED_QUERIES["histograma_disciplina"](w).collect()
    bands = {r["disciplina"]: tuple(r)[1:7] for r in counted}
    assert bands["D"] == (2, 2, 2, 2, 2, 10)
    assert bands["vazia"] == (0, 0, 0, 0, 0, 1)
    labels = {r[0]: tuple(r)[1:] for r in NAMED_QUERIES["ranking_disciplinas"](w).collect()}
    assert labels["sete"] == (7.0, 2, "Excelente")
    # The label follows the unrounded mean, 6.999, which prints as 7.0.
    assert labels["quase"] == (7.0, 3, "Bom")
    assert labels["seis"] == (6.0, 4, "Bom")
    assert labels["cinco"][2] == "Regular"
    assert labels["menos"][2] == "Precisa Melhorar"
    assert labels["vazia"] == (None, 1, "Precisa Melhorar")


def test_empty_warehouse(spark):
    w = make_warehouse(spark, [], [], [])
    for name, question in NAMED_QUERIES.items():
        assert rows(question(w)) == [], name
    assert rows(media_global(w)) == [(0, None)]


# --- brute force -------------------------------------------------------------------------


def _r2(x: Fraction | None) -> float | None:
    if x is None:
        return None
    scaled = abs(x) * 100
    return math.copysign(math.floor(scaled + Fraction(1, 2)) / 100, x)


def _mean(grades):
    return Fraction(sum(grades)) / len(grades) if grades else None


def _sd(grades):
    if len(grades) < 2:
        return None
    value = Decimal(repr(statistics.stdev([float(g) for g in grades])))
    for places in ("1.0000000000", "1.00"):
        value = value.quantize(Decimal(places), ROUND_HALF_UP)
    return float(value)


def _pct(grades, p):
    if not grades:
        return None
    g = sorted(grades)
    at = (len(g) - 1) * Fraction(p)
    low = math.floor(at)
    high = min(low + 1, len(g) - 1)
    return _r2(g[low] + (g[high] - g[low]) * (at - low))


def _stats(grades):
    return {
        "n": len(grades),
        "media": _r2(_mean(grades)),
        "sd": _sd(grades),
        "min": float(min(grades)) if grades else None,
        "max": float(max(grades)) if grades else None,
    }


def awkward_data(seed=7, n_schools=30, n_students=200, n_grades=1500):
    """A third of each table on one key, repeated keys, NULLs, orphans and many equal means."""
    rnd = random.Random(seed)
    regions = ["Norte", "Sul", None, "Leste"]

    def pick(hot, others):
        return hot if rnd.random() < 1 / 3 else rnd.choice(others)

    schools = [
        (f"E{i}", f"Escola {i}", rnd.choice(["pública", "privada", None]), pick("Norte", regions))
        for i in range(n_schools)
    ]
    schools += [schools[0], schools[3], (None, "sem id", "pública", "Sul")]
    schools.append((schools[1][0], "outro nome", "privada", "Sul"))
    ids = [f"A{i}" for i in range(n_students)]
    students = [
        (pick("A0", ids) if i % 9 == 0 else f"A{i}", pick("E0", [s[0] for s in schools] + ["X1"]))
        for i in range(n_students)
    ]
    students += [(None, "E2"), ("A5", None), students[8], students[8]]
    subjects = ["Matemática", "Português", "Inglês", None]
    grades = [
        (
            pick("A0", [*ids, "Z1", None]),
            pick("Matemática", subjects),
            None if rnd.random() < 0.03 else Decimal(rnd.choice([100, rnd.randint(0, 100)])) / 10,
        )
        for _ in range(n_grades)
    ]
    return schools, students, grades


def linked(schools, students, grades):
    """School x student x grade rows as SQL left joins give them."""
    by_school, by_student = defaultdict(list), defaultdict(list)
    for sid, school in students:
        by_school[school].append(sid)
    for sid, subject, grade in grades:
        by_student[sid].append((subject, grade))
    out = []
    for school in schools:
        enrolled = by_school.get(school[0], []) if school[0] is not None else []
        for sid in enrolled or [None]:
            results = by_student.get(sid, []) if sid is not None else []
            out += [(school, sid, subject, g) for subject, g in results or [(None, None)]]
    return out


def _grouped(items, key):
    groups = defaultdict(list)
    for item in items:
        groups[key(item)].append(item)
    return groups


def _fractions(values):
    return [Fraction(v) for v in values if v is not None]


def expected(name, schools, students, grades):
    link = linked(schools, students, grades)
    by_subject = _grouped(grades, lambda g: g[1])

    def distinct(items, pick):
        return len({pick(i) for i in items} - {None})

    def school_groups(key):
        for k, items in _grouped(link, key).items():
            yield k, items, _stats(_fractions(i[3] for i in items))

    if name == "media_por_escola":
        return [
            (*k, distinct(i, lambda x: x[1]), s["n"], s["media"], s["min"], s["max"], s["sd"])
            for k, i, s in school_groups(lambda x: x[0])
        ]
    if name == "media_por_regiao":
        return [
            (k, distinct(i, lambda x: x[0][0]), distinct(i, lambda x: x[1]), s["n"], s["media"],
             s["min"], s["max"])
            for k, i, s in school_groups(lambda x: x[0][3])
        ]
    if name == "rede_por_regiao":
        return [
            (*k, distinct(i, lambda x: x[0][0]), distinct(i, lambda x: x[1]), s["media"])
            for k, i, s in school_groups(lambda x: (x[0][3], x[0][2]))
        ]
    if name == "comparacao_redes":
        return [
            (k, distinct(i, lambda x: x[0][0]), distinct(i, lambda x: x[1]), s["n"], s["media"],
             s["sd"], s["min"], s["max"], _pct(_fractions(x[3] for x in i), 0.5))
            for k, i, s in school_groups(lambda x: x[0][2])
        ]
    if name == "ranking_escolas_regiao":
        means = [
            (k, _mean(_fractions(x[3] for x in i)))
            for k, i in _grouped(link, lambda x: x[0]).items()
        ]
        out = []
        for region, items in _grouped(means, lambda m: m[0][3]).items():
            known = [m for _, m in items if m is not None]
            for school, m in items:
                above = 0 if m is None else sum(x is None or x > m for _, x in items)
                out.append((region, school[1], school[2], _r2(m), 1 + above, _r2(_mean(known))))
        return out
    if name == "estatisticas_disciplina":
        out = []
        for k, items in by_subject.items():
            g = _fractions(i[2] for i in items)
            s = _stats(g)
            out.append(
                (k, sum(i[0] is not None for i in items), distinct(items, lambda x: x[0]),
                 s["media"], s["sd"], s["min"], s["max"], *[_pct(g, p) for p in (0.25, 0.5, 0.75)])
            )
        return out
    if name == "histograma_disciplina":
        out = []
        for k, items in by_subject.items():
            g = _fractions(i[2] for i in items)
            bands = [
                sum(lo <= x < lo + 2 or (lo == 8 and x == 10) for x in g) for lo in range(0, 10, 2)
            ]
            out.append((k, *bands, len(items), _r2(_mean(g))))
        return out
    if name == "ranking_disciplinas":
        means = {k: _mean(_fractions(i[2] for i in items)) for k, items in by_subject.items()}

        def label(m):
            if m is None or m < 5:
                return "Precisa Melhorar"
            return "Excelente" if m >= 7 else "Bom" if m >= 6 else "Regular"

        def above(m):
            return 0 if m is None else sum(x is None or x > m for x in means.values())

        return [(k, _r2(m), 1 + above(m), label(m)) for k, m in means.items()]
    if name == "disciplina_por_rede":
        inner = [x for x in link if x[1] is not None and x[1] in {g[0] for g in grades}]
        out = []
        for k, items in _grouped(inner, lambda x: (x[2], x[0][2])).items():
            s = _stats(_fractions(x[3] for x in items))
            out.append((*k, s["n"], s["media"], s["sd"]))
        return out
    raise KeyError(name)


@pytest.mark.parametrize("name", GOLDEN)
def test_brute_force_on_awkward_data(spark, name):
    data = awkward_data()
    got = rows(NAMED_QUERIES[name](make_warehouse(spark, *data)))
    assert sorted(got, key=repr) == sorted(expected(name, *data), key=repr)


def test_group_totals_agree(spark):
    """Schools and students of a region add up over its networks when keys are unique."""
    schools, students, grades = awkward_data()
    schools = list({s[0]: s for s in schools if s[0]}.values())
    students = list({s[0]: s for s in students if s[0]}.values())
    w = make_warehouse(spark, schools, students, grades)
    whole = {r["regiao"]: (r["total_escolas"], r["total_alunos"])
             for r in NAMED_QUERIES["media_por_regiao"](w).collect()}
    parts = defaultdict(lambda: (0, 0))
    for r in NAMED_QUERIES["rede_por_regiao"](w).collect():
        e, a = parts[r["regiao"]]
        parts[r["regiao"]] = (e + r["total_escolas"], a + r["total_alunos"])
    assert whole == dict(parts)


# Groups whose mean is NULL, beside others: where each question puts them.
NULL_FIRST = {
    "comparacao_redes": ("rede", [("vazia",), ("privada",), ("pública",)]),
    "rede_por_regiao": ("rede", [("vazia",), ("privada",), ("pública",)]),
    "estatisticas_disciplina": ("disciplina", [("Sem nota",), ("Matemática",)]),
    "ranking_disciplinas": ("disciplina", [("Sem nota",), ("Matemática",)]),
    "disciplina_por_rede": ("rede", [("privada",), ("pública",), ("pública",)]),
}


@pytest.mark.parametrize("name", NULL_FIRST)
def test_null_means_come_first(spark, name):
    w = make_warehouse(
        spark,
        [("E1", "a", "pública", "Sul"), ("E2", "b", "privada", "Sul"), ("E3", "c", "vazia", "Sul")],
        [("A1", "E1"), ("A2", "E2")],
        [("A1", "Matemática", 5.0), ("A2", "Matemática", 9.0), ("A1", "Sem nota", None)],
    )
    column, want = NULL_FIRST[name]
    assert rows(NAMED_QUERIES[name](w).select(column)) == want
