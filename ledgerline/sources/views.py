"""Named views for SQL users (S14): the raw layer and the published marts.

Spark temp-view names cannot contain a dot, so the reference's ``raw.<table>``
and ``analytics.<view>`` become ``raw_<table>`` and ``analytics_<view>``.
Views are plans, not copies: registering one runs nothing (the scorecard ranks
with live splitters, see ``plans.ranking``), querying one runs the job on the rows
that are there then.

A plan reads the files of the load that was in force when it was made.
``register_warehouse`` therefore remembers which views stand on a warehouse folder,
and a load into that folder registers them again, so the same names show
the new rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


def register(frames: Mapping[str, DataFrame], prefix: str) -> list[str]:
    names = []
    for name, df in frames.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def register_layers(tables, statement: str | None = None) -> list[str]:
    """``raw_*`` views of a ``jobs.Tables`` and ``analytics_vw_*`` views of its marts.

    With ``statement``, only the views whose names occur in it.
    """
    from ledgerline.jobs import MARTS, live_scorecard

    def named(view: str) -> bool:
        return statement is None or view.lower() in statement.lower()

    marts = {**MARTS, "vw_agent_scorecard": live_scorecard}
    names = register({n: df for n, df in tables.raw().items() if named(f"raw_{n}")}, "raw_")
    return names + register({n: fn(tables) for n, fn in marts.items() if named(f"analytics_{n}")}, "analytics_")


def _standing(spark: SparkSession) -> dict[str, Callable[[], list[str]]]:
    """What to register again after a load, by warehouse folder (of this session)."""
    return spark.__dict__.setdefault("_ledgerline_views", {})


def register_warehouse(spark: SparkSession, root: str) -> list[str]:
    """The views of both layers over the tables in force under ``root``, renewed by every later load into it."""
    from ledgerline import schemas
    from ledgerline.jobs import Tables
    from ledgerline.sources import files

    def build() -> list[str]:
        t = {n: files.read_table(spark, f"{root}/{n}", kind) for n, kind in schemas.RAW_TABLES.items()}
        return register_layers(Tables(accounts=t["accounts"], products=t["products"], sales_teams=t["sales_teams"],
                                      pipeline=t["sales_pipeline"], subscriptions_table=t["subscriptions"]))

    _standing(spark)[root.rstrip("/")] = build
    return build()


def renew(spark: SparkSession, root: str) -> None:
    """Register the views that stand on ``root`` again (after a load)."""
    build = _standing(spark).get(root.rstrip("/"))
    if build:
        build()
