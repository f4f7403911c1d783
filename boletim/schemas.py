"""The three entities: their raw columns, stored types, keys and references."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    sql_type: str
    length: int | None = None


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Entity:
    """One dataset. ``raw_name`` is its folder in the raw layer, ``name`` everywhere else."""

    name: str
    raw_name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    comment: str
    partition_by: str | None = None
    reference: Reference | None = None

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def lengths(self) -> dict[str, int]:
        return {c.name: c.length for c in self.columns if c.length}


def _text(name: str, length: int) -> Column:
    return Column(name, f"varchar({length})", length)


# Dataset, column and table names, lengths, numeric types and comments.
ESCOLA = Entity(
    name="escola",
    raw_name="escolas",
    columns=(
        _text("escola_id", 50),
        _text("nome", 255),
        _text("rede", 50),
        _text("regiao", 50),
    ),
    key=("escola_id",),
    comment="Tabela de escolas",
    partition_by="regiao",
)
ALUNO = Entity(
    name="aluno",
    raw_name="alunos",
    columns=(
        _text("id", 50),
        _text("nome", 255),
        Column("idade", "int"),
        _text("genero", 10),
        _text("escola_id", 50),
    ),
    key=("id",),
    comment="Tabela de alunos",
    reference=Reference("escola_id", "escola", "escola_id"),
)
NOTA = Entity(
    name="nota",
    raw_name="notas",
    columns=(
        _text("aluno_id", 50),
        _text("disciplina", 50),
        Column("nota", "decimal(4,1)"),
    ),
    key=("aluno_id", "disciplina"),
    comment="Tabela de notas dos alunos por disciplina",
    partition_by="disciplina",
    reference=Reference("aluno_id", "aluno", "id"),
)
GRADE_RANGE = (0, 10)
INGESTION_COLUMN = "ingestion_time"
AUDIT_COLUMNS = ("created_at", "updated_at")

# Parents first: the order in which tables are written, checked and loaded.
ENTITIES: dict[str, Entity] = {e.name: e for e in (ESCOLA, ALUNO, NOTA)}


def entity(name: str) -> Entity:
    """Look an entity up by its raw or its stored name."""
    for e in ENTITIES.values():
        if name in (e.name, e.raw_name):
            return e
    raise ValueError(f"unknown entity {name!r}; expected one of {sorted(ENTITIES)}")


def raw_schema(name: str) -> T.StructType:
    """All text: types are given by the cleaning step, so no inference pass is needed."""
    return T.StructType([T.StructField(c, T.StringType()) for c in entity(name).column_names])


def processed_schema(name: str) -> T.StructType:
    """Schema of the cleaned Parquet layer, where a grade is still a double."""
    numeric = {"idade": T.IntegerType(), "nota": T.DoubleType()}
    fields = [T.StructField(c, numeric.get(c, T.StringType())) for c in entity(name).column_names]
    stamps = (INGESTION_COLUMN, *AUDIT_COLUMNS)
    return T.StructType(fields + [T.StructField(c, T.TimestampNTZType()) for c in stamps])
