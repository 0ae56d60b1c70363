"""Point lookups (P9) and named, parameterised queries.

Lookups are ordinary filters, so the predicate is pushed into the parquet
scan; the SQL form binds parameters with ``spark.sql(text, args=...)``
instead of splicing text.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..sources.views import Views


def program_by_name(program: DataFrame, name: str) -> DataFrame:
    return program.where(F.col("ProgramName") == name)


def parts_by_packet(st_pip_arc: DataFrame, packet_id: int, code: str = codes.FEEDBACK_CREATED) -> DataFrame:
    return st_pip_arc.where((F.col("ArchivePacketID") == packet_id) & (F.col("TransType") == code))


def remnants_by_program(remnant: DataFrame, program: str, repeat_id: int) -> DataFrame:
    return remnant.where((F.col("ProgramName") == program) & (F.col("RepeatID") == repeat_id))


def sql_lookup(spark: SparkSession, view: DataFrame, sql: str, **params) -> DataFrame:
    """Run parameterised SQL (``:name`` markers) over ``view`` registered as
    the temp view ``t``."""
    view.createOrReplaceTempView("t")
    return spark.sql(sql, args=params)


#: Types of parameters, and how their text is read.
TYPES = {"string": str, "int": int, "double": float, "date": _dt.date.fromisoformat}


@dataclass(frozen=True)
class NamedSql:
    """A query with declared parameters: ``:name`` markers in the text are bound as
    typed values and never spliced; ``{view}`` stands for a view of the shop."""

    sql: str
    views: tuple[str, ...]
    types: dict[str, str]
    defaults: dict[str, object]

    def values(self, given: dict[str, object]) -> dict[str, object]:
        """The bound values; unknown, missing and wrongly typed ones are errors."""
        unknown = sorted(set(given) - set(self.types))
        if unknown:
            raise ValueError(f"unknown parameters {unknown}; declared: {self.types}")
        out = {**self.defaults, **given}
        missing = sorted(set(self.types) - set(out))
        if missing:
            raise ValueError(f"missing parameters {missing}")
        for name, kind in self.types.items():
            read = TYPES[kind]
            if isinstance(out[name], str) and kind != "string":
                try:
                    out[name] = read(out[name])
                except ValueError:
                    raise ValueError(f"{name} is no {kind}: {out[name]!r}") from None
            elif not isinstance(out[name], {"date": _dt.date}.get(kind, read)) or isinstance(out[name], bool):
                raise ValueError(f"{name} is no {kind}: {out[name]!r}")
        return out

    def __call__(self, spark: SparkSession, sf_dir: str, **given) -> DataFrame:
        v = Views(spark, sf_dir)
        return spark.sql(self.sql, args=self.values(given), **{name: getattr(v, name) for name in self.views})


NAMED_SQL = {
    "named_program": NamedSql(
        "SELECT * FROM {program} WHERE ProgramName = :program", ("program",), {"program": "string"}, {"program": "PRG7"}
    ),
    "named_open_programs": NamedSql(
        """
        SELECT m.MachineName, m.ProgramName, m.CuttingTime, r.Repeats
        FROM (SELECT DISTINCT MachineName, ProgramName, CuttingTime FROM {program_machine} WHERE MachineName = :machine) m
        JOIN (
          SELECT p.ProgramName, CAST(count(p.RepeatID) AS INT) AS Repeats
          FROM {program} p LEFT ANTI JOIN (SELECT ProgramName, ProgramRepeat FROM {trans_act} WHERE TransType = 'SN70') t
            ON t.ProgramName = p.ProgramName AND t.ProgramRepeat = p.RepeatID
          GROUP BY p.ProgramName
        ) r ON r.ProgramName = m.ProgramName
        WHERE r.Repeats >= :least
        """,
        ("program_machine", "program", "trans_act"), {"machine": "string", "least": "int"}, {"machine": "1-URGENT", "least": 1},
    ),
    "named_nest_parts": NamedSql(
        """
        SELECT DISTINCT i.ProgramName, i.WONumber, coalesce(i.PartName, '') AS partName, i.QtyInProcess AS partQty, coalesce(p.Data1, '') AS job, i.TrueArea AS trueArea, i.NestedArea AS nestedArea
        FROM {pip} i JOIN {part_wo} p ON p.PartName = i.PartName AND p.WONumber = i.WONumber
        WHERE i.ProgramName = :program AND i.TrueArea >= :area
        """,
        ("pip", "part_wo"), {"program": "string", "area": "double"}, {"program": "PRG7", "area": 0.0},
    ),
}


def run_named(queries: dict, name: str, spark: SparkSession, sf_dir: str, params: dict[str, object] | None = None) -> DataFrame:
    """Run a registered query by name, with parameters if it declares any; an
    unknown name is an error, and so are parameters of a query without."""
    try:
        fn = queries[name]
    except KeyError:
        raise KeyError(f"unknown query {name!r}; known: {', '.join(sorted(queries))}") from None
    if params and not isinstance(fn, NamedSql):
        raise ValueError(f"{name} takes no parameters")
    return fn(spark, sf_dir, **(params or {}))
