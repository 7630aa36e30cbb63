"""The catalogue of scene, run and raster queries, each as one SQL text that Spark and DuckDB share.

Pixels are lines (run = order, band = return flag, class = line status), runs are orders, scenes are customers with
their nation as tile; rasters are the embedding table (row = vec_id, column = position). Where the dialects differ, a
text has {spark|duckdb} alternatives.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sources.tables import TABLES, views

_RUNS = "runs AS (SELECT o_orderkey AS run_id, o_custkey AS scene_id, o_orderstatus AS status, o_orderdate AS staged_at, o_totalprice AS price FROM orders)"
_SCENES = "scenes AS (SELECT c_custkey AS scene_id, n_name AS tile_id, c_acctbal AS sun_zenith FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_PIXELS = "px AS (SELECT l_orderkey AS run_id, l_returnflag AS band, l_linestatus AS class, l_extendedprice AS v, l_discount AS d, l_shipdate AS t FROM lineitem)"
_GRID = "grid AS (SELECT vec_id AS r, c, label, v FROM (SELECT vec_id, label, {posexplode(embedding) AS (c, v)|unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS c} FROM embeddings) g)"
_FRACTION = "frac AS (SELECT run_id, sum(CASE WHEN class = 'F' THEN 1 ELSE 0 END) * 1e0 / count(*) AS cloud FROM px WHERE class IN ('F', 'O') AND run_id IN (SELECT run_id FROM runs WHERE status = 'F') GROUP BY run_id)"

SQL: dict[str, str] = {
    "tile_overview": f"WITH {_RUNS}, {_SCENES} SELECT tile_id, count(*) AS n_scenes, min(staged_at) AS first_at, max(staged_at) AS last_at, round(avg(sun_zenith), 4) AS mean_zenith FROM runs JOIN scenes USING (scene_id) WHERE status = 'F' GROUP BY tile_id",
    "cloud_cover_summary": f"WITH {_RUNS}, {_SCENES}, {_PIXELS}, {_FRACTION} SELECT tile_id, round(avg(cloud) * 100, 4) AS mean_pct, round(min(cloud) * 100, 4) AS min_pct, round(max(cloud) * 100, 4) AS max_pct, round(median(cloud) * 100, 4) AS median_pct FROM frac JOIN runs USING (run_id) JOIN scenes USING (scene_id) WHERE status = 'F' GROUP BY tile_id",
    "monthly_cloud_fraction": f"WITH {_RUNS}, {_SCENES}, {_PIXELS}, {_FRACTION} SELECT tile_id, CAST(extract(month FROM staged_at) AS INT) AS month, round(avg(cloud), 6) AS cloud_fraction, count(*) AS n FROM frac JOIN runs USING (run_id) JOIN scenes USING (scene_id) WHERE status = 'F' GROUP BY tile_id, CAST(extract(month FROM staged_at) AS INT)",
    "class_fractions": f"WITH {_PIXELS} SELECT run_id, round(sum(CASE WHEN class = 'F' THEN 1 ELSE 0 END) * 1e0 / count(*), 6) AS clear_frac, round(sum(CASE WHEN class = 'O' THEN 1 ELSE 0 END) * 1e0 / count(*), 6) AS cloud_frac, count(*) AS n_pixels FROM px WHERE class IN ('F', 'O') GROUP BY run_id",
    "properties_timeseries": f"WITH {_RUNS}, {_SCENES}, {_PIXELS}, m AS (SELECT run_id, avg(v) AS mean_v, median(d) AS median_d FROM px GROUP BY run_id) SELECT tile_id, run_id, staged_at, round(mean_v, 6) AS mean_v, round(median_d, 6) AS median_d FROM m JOIN runs USING (run_id) JOIN scenes USING (scene_id) WHERE status = 'F'",
    "status_counts": f"WITH {_RUNS} SELECT status, count(*) AS n FROM runs GROUP BY status",
    "status_matrix": f"WITH {_RUNS} SELECT scene_id, sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END)::BIGINT AS done, sum(CASE WHEN status = 'O' THEN 1 ELSE 0 END)::BIGINT AS staged, sum(CASE WHEN status = 'P' THEN 1 ELSE 0 END)::BIGINT AS failed FROM runs GROUP BY scene_id",
    "pending_runs": f"WITH {_RUNS} SELECT run_id, scene_id, staged_at FROM runs WHERE status IN ('O', 'P')",
    "stale_done_runs": f"WITH {_RUNS}, h AS (SELECT *, CASE WHEN run_id % 3 = 0 THEN NULL WHEN run_id % 3 = 1 THEN 'new' ELSE 'old' END AS config_hash FROM runs) SELECT run_id, config_hash FROM h WHERE status = 'F' AND config_hash IS DISTINCT FROM 'new'",
    "reset_stale": f"WITH {_RUNS} SELECT run_id, CASE WHEN status = 'P' THEN 'O' ELSE status END AS status FROM runs",
    "run_id_hash": f"WITH {_RUNS} SELECT run_id, substr({{sha2(concat(CAST(scene_id AS STRING), ':', ''), 256)|sha256(concat(CAST(scene_id AS VARCHAR), ':'))}}, 1, 16) AS run_hash FROM runs",
    "threshold_mask": "SELECT vec_id, c, CASE WHEN NOT isnan(v) AND v > 0.06 THEN 1 ELSE 0 END AS mask FROM (SELECT r AS vec_id, c, v FROM (WITH " + _GRID + " SELECT * FROM grid) z) y",
    "binary_mask": "SELECT vec_id, CASE WHEN label IN (1, 2) THEN 1 ELSE 0 END AS mask FROM embeddings",
    "phase_mask": "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount > 0.05 THEN NULL ELSE l_quantity END AS r_eff_liq, CASE WHEN l_discount < 0.05 THEN NULL ELSE l_quantity END AS r_eff_ice FROM lineitem",
    "rgb_stretch": "WITH " + _GRID + " SELECT r, c, round(least(greatest(power(greatest(least(greatest(CAST(v AS DOUBLE) * 2.5e0 + 0.1e0, 0), 1), 0), 0.8e0), 0), 1), 5) AS x FROM grid",
    "minmax_norm": "WITH " + _GRID + ", e AS (SELECT c, min(v) AS lo, max(v) AS hi FROM grid GROUP BY c) SELECT r, c, round(2 * (v - lo) / greatest(hi - lo, 1e-8) - 1, 5) AS x FROM grid JOIN e USING (c)",
    "stride_downsample": "WITH " + _GRID + " SELECT {r div 4|r // 4} AS r, {c div 4|c // 4} AS c, v FROM grid WHERE r % 4 = 0 AND c % 4 = 0",
    "rotation": "SELECT vec_id, round({embedding[0]|embedding[1]} * cos(0.5) + {embedding[1]|embedding[2]} * sin(0.5), 5) AS x, round(-{embedding[0]|embedding[1]} * sin(0.5) + {embedding[1]|embedding[2]} * cos(0.5), 5) AS y FROM embeddings",
    "band_mae": f"WITH {_PIXELS} SELECT band, round(avg(abs(d - 0.05)), 6) AS mae, round(avg(power(d - 0.05, 2)), 8) AS mse FROM px GROUP BY band",
}


def _dialect(text: str, at: int) -> str:
    text = re.sub(r"\{([^{}|]*)\|([^{}|]*)\}", lambda m: m[at + 1], text)
    return text if at else text.replace("::BIGINT", "")


def _query(text: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views(spark, sf_dir, tuple(t for t in TABLES if re.search(rf"\b{t}\b", text)))
        return spark.sql(_dialect(text, 0))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(text) for name, text in SQL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: _dialect(text, 1) for name, text in SQL.items()}
