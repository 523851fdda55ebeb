"""Small-frame helpers for the tests."""

from __future__ import annotations

import datetime as dt


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def prices(spark, *rows):
    """(coin, date, price) rows as a price frame."""
    return spark.createDataFrame(
        [(c, day(d), None if p is None else float(p)) for c, d, p in rows],
        "coin_id string, date date, price double",
    )


def fact(spark, *rows):
    """(coin, date, price[, market_cap, volume]) rows as a fact frame."""
    full = []
    for coin, date, price, *rest in rows:
        cap, volume = (rest + [None, None])[:2]
        full.append((coin, day(date) if date else None, price, cap, volume))
    return spark.createDataFrame(
        full, "coin_id string, date date, price double, market_cap double, volume double"
    )


def rows(df, *columns):
    """Sorted tuples of the named columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*(order or ("coin_id", "date"))).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df) -> dict[str, int]:
    """Run ``df`` and add up the metrics of its scans that read the most."""
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollectPublic()
    found: dict[str, int] = {}

    def walk(node) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "FileSourceScanExec":
            metrics = node.metrics()
            for name in ("numOutputRows", "numFiles", "numPartitions"):
                if metrics.contains(name):
                    found[name] = max(found.get(name, 0), metrics.apply(name).value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(query.executedPlan())
    return found
