"""Sync state that gateways report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ENGINE_KEY = ["network_id", "engine_id"]
VARIABLE_TYPES = {"Long": "bigint", "Double": "double", "Boolean": "boolean",
                  "String": "string"}


def latest_sync(metadata: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Newest row of each engine deployment by `sync_date`, then `seq`, then
    `report` where there is one, so that equal dates are decided the same each time.

    A maximum is combined before the shuffle; a ranking window would bring all
    rows of a busy deployment to one task.
    """
    key = key or ENGINE_KEY
    order = [c for c in ("sync_date", "seq", "report") if c in metadata.columns]
    rest = [c for c in metadata.columns if c not in (*key, *order)]
    newest = F.max_by(F.struct(*order, *rest), F.struct(*order))
    return (metadata.groupBy(*key).agg(newest.alias("newest"))
            .select(*key, "newest.*").select(*metadata.columns))


def network_summary(metadata: DataFrame, instances: DataFrame | None = None) -> DataFrame:
    """Deployments of each network by state, newest sync, running instances.

    A network that only has instances is a row too. Both sides go through one
    aggregation.
    """
    live = ~F.col("is_placeholder") & ~F.col("marked_for_delete")
    counts = {"n_deployments": F.lit(True), "n_placeholders": F.col("is_placeholder"),
              "n_deleting": F.col("marked_for_delete"), "n_live": live}
    rows = metadata.select("network_id", *(c.alias(n) for n, c in counts.items()), "sync_date")
    names = list(counts)
    if instances is not None:
        rows = rows.unionByName(instances.select(
            "network_id", F.lit(True).alias("n_instances"), (~F.col("ended")).alias("n_running")),
            allowMissingColumns=True)
        names += ["n_instances", "n_running"]
    states = [F.count_if(F.col(n)).alias(n) for n in names]
    return rows.groupBy("network_id").agg(
        *states[:4], F.max("sync_date").alias("newest_sync"), *states[4:])


def explode_parameters(metadata: DataFrame) -> DataFrame:
    """Process parameters as rows `(name, type, value_*)`.

    The value is cast by its declared type into the column of that type; a
    value that does not fit, or an undeclared type, leaves the columns null.
    """
    kept = [c for c in metadata.columns if c != "process_parameter"]
    rows = metadata.select(*kept, F.explode("process_parameter").alias("name", "variable"))
    columns = [
        F.when(F.col("variable.type") == declared,
               F.try_variant_get("variable.value", "$", kind)
               ).alias(f"value_{declared.lower()}")
        for declared, kind in VARIABLE_TYPES.items()
    ]
    return rows.select(*kept, "name", F.col("variable.type").alias("type"), *columns)
