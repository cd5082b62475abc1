"""Raw landing tables -> typed records, failure log, conformed records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inciscope import config
from inciscope.functions.text import standardise
from inciscope.operators.joins import DimSpec, conform
from inciscope.operators.quality import Gate, gate_summary, incident_failures, incident_gates
from inciscope.operators.shaping import dedup_latest, delete_where, keep_castable, latest_values, select_as, union_tagged
from inciscope.operators.typing import COORDINATES, clean_dim, derived_columns, incident_parts, to_typed
from inciscope.sources import logs
from inciscope.sources.tables import AuditRow, delete_rows, read_table, write_audited, write_table


def clean_wards(raw: DataFrame) -> DataFrame:
    labels = {"ward_label": F.concat(F.lit("Ward "), F.trim(F.col("ward")))}
    measures = {"shape_area": "shape_area", "shape_leng": "shape_leng"}
    return clean_dim(raw, "ward", "ward_num", labels, measures)


def clean_districts(raw: DataFrame) -> DataFrame:
    return clean_dim(raw, "dist_num", "district_num", {"district_label": standardise(F.col("dist_label"))})


def clean_areas(raw: DataFrame) -> DataFrame:
    measures = {"shape_area": "shape_area", "shape_len": "shape_len"}
    return clean_dim(raw, "area_numbe", "area_num", {"community_name": standardise(F.col("community"))}, measures)


def deleted_places() -> Column:
    """Area 0, or a district outside the served ones; NULLs stay."""
    district = F.col("district").try_cast("int")
    return (F.col("community_area") == config.DELETED_AREA) | district.isin(*config.DELETED_DISTRICTS)


def latest_incidents(
    typed: DataFrame, order_by: Sequence[Column], columns: Sequence[str] | None = None,
    rows_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per incident id among rows with a time; all its columns or those named.

    Columns that follow from others are worked out again after the shuffle rather than sorted and moved: they come after
    the columns they follow from, so the order of ties is the same without them. Nor are columns moved that are not
    asked for; ``rows_of`` gives the typed rows of a table of ids (see ``latest_values``).
    """
    derived = derived_columns()

    def dated(rows: DataFrame) -> DataFrame:
        return rows.dropna(subset=["incident_datetime"]).drop(*derived)

    narrow = dated(typed)
    if columns is None:
        return dedup_latest(narrow, ["crime_id"], order_by).withColumns(derived).select(*typed.columns)
    wanted = {name: expr for name, expr in derived.items() if name in columns}
    sources = {"incident_datetime"} | set(COORDINATES if wanted.keys() - incident_parts().keys() else ())
    moved = [c for c in narrow.columns if c in columns or (wanted and c in sources)]
    of_ids = (lambda ids: dated(rows_of(ids))) if rows_of else None
    return latest_values(narrow, ["crime_id"], order_by, moved, of_ids).withColumns(wanted).select(*columns)


def conform_incidents(deduped: DataFrame, districts: DataFrame, wards: DataFrame, areas: DataFrame) -> DataFrame:
    """Join the dimensions and name the columns as the conformed table has them; those whose columns are not in
    ``deduped`` are left out."""
    lookups = {
        "district": DimSpec(districts, "district_num", F.col("district").try_cast("int"), {"district_label": "district_name"}),
        "ward": DimSpec(wards, "ward_num", F.col("ward"), {"ward_label": "ward_label"}),
        "community_area": DimSpec(areas, "area_num", F.col("community_area"), {"community_name": "community_name"}),
    }
    joined = conform(deduped, [spec for column, spec in lookups.items() if column in deduped.columns])
    kept = [
        "crime_id", "case_number", "incident_datetime", "incident_year", "incident_month", "incident_day",
        "incident_hour", "incident_dayofweek", "block", "iucr", "primary_type", "crime_description",
        "location_description", "fbi_code", "is_arrest", "is_domestic", "beat",
    ]
    spec = {name: name for name in kept}
    spec |= {"district_code": "district", "ward_num": "ward", "community_area_num": "community_area"}
    spec |= {name: name for name in ["district_name", "ward_label", "community_name"]}
    spec |= {name: name for name in ["lat_final", "lon_final", "coord_source", "source_year_range", "_source_file"]}
    spec = {name: source for name, source in spec.items() if source in joined.columns}
    spec |= {"_silver_step": F.lit("STEP7_CONFORMED"), "_transform_ts": F.current_timestamp()}
    return select_as(joined, spec)


def build_silver(
    spark: SparkSession,
    root: str,
    landings: Mapping[str, str],
    dims: tuple[str, str, str],
    run_id: str,
    gates: Sequence[Gate] | None = None,
    purge: bool = False,
) -> DataFrame:
    """Run the layer from stored landings; returns the gate summary.

    ``landings`` maps a tag to each fact landing path, ``dims`` are the district, ward and area landing paths.
    Typed and conformed records are the only fact tables stored; everything between them is one lazy chain. Typed
    records are written without a shuffle. Running again under the same ``run_id`` replaces that run's failures.

    The deleted places are left out of the conformed records. With ``purge`` they are also deleted from the stored typed
    records, after the gates have seen them. Such rows are written to files of their own, so the delete drops these files
    and rewrites none.
    """
    with logs.logged_run(spark, root, run_id, "silver_transform", "SILVER", "plans/silver.py") as run:
        return _build(spark, root, landings, dims, run_id, gates, purge, run)


def _table(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _build(spark, root, landings, dims, run_id, gates, purge, run) -> DataFrame:
    cleaners = zip(("dim_districts", "dim_wards", "dim_community_areas"), dims, (clean_districts, clean_wards, clean_areas))
    audits = [
        write_audited(
            read_table(spark, path), clean, f"{root}/silver/{name}", "STEP3_CLEAN_DIMS", source_table=_table(path),
            notes="rows without an integer key dropped, labels standardised",
        )
        for name, path, clean in cleaners
    ]
    districts, wards, areas = (
        read_table(spark, f"{root}/silver/{name}") for name in ("dim_districts", "dim_wards", "dim_community_areas")
    )

    raw = union_tagged({tag: read_table(spark, path) for tag, path in landings.items()}, "yr_range")
    audits.append(
        write_audited(
            raw,
            lambda rows: to_typed(keep_castable(rows, "id", "bigint"), carry=["_ingest_ts"]),
            f"{root}/silver/crimes_typed",
            "STEP4_TYPE_CAST_STANDARDISE",
            source_table=", ".join(map(_table, landings.values())),
            notes="rows without an integer id dropped, columns typed and standardised",
            apart=deleted_places() if purge else None,
        )
    )
    typed, n_typed = read_table(spark, f"{root}/silver/crimes_typed"), audits[-1].rows_out

    failures = incident_failures(typed, districts, gates or incident_gates()).withColumns(
        {
            "run_id": F.lit(run_id),
            "source_table": F.lit("silver.crimes_typed"),
            "target_table": F.lit("silver.crimes_deduped"),
            "zone": F.lit("SILVER"),
            "detected_at": F.current_timestamp(),
        }
    )
    rejected = write_table(failures, f"{root}/{logs.FAILURE_LOG}", ["run_id"], token=run_id)

    if purge:
        done = delete_rows(spark, f"{root}/silver/crimes_typed", deleted_places())
        notes = f"rows of deleted places deleted; {done.files_rewritten} of {done.files} files rewritten"
        audits.append(AuditRow("STEP5_GEOGRAPHY_FILTER_DELETE", "crimes_typed", done.rows_in, done.rows_out, "crimes_typed", notes))
        typed = read_table(spark, f"{root}/silver/crimes_typed")

    def conformed(rows: DataFrame) -> DataFrame:
        """What settles ties only after all columns of the conformed records is not sorted and moved: rows that differ in
        nothing else give the same record."""
        kept = delete_where(rows, deleted_places()).drop("_raw_date", "_silver_step", "_transform_ts")
        newest = [F.desc("_ingest_ts"), F.desc("source_year_range")]
        return conform_incidents(latest_incidents(kept, newest), districts, wards, areas)

    path, rows_in = f"{root}/silver/crimes_conformed", audits[-1].rows_out
    notes = "deleted places and older duplicates dropped, dimensions joined"
    audits.append(write_audited(typed, conformed, path, "STEP7_DIMENSION_JOIN", rows_in, "crimes_typed", notes))
    logs.log_steps(spark, root, run_id, audits)
    run.processed, run.rejected = audits[-1].rows_out, rejected
    logged = read_table(spark, f"{root}/{logs.FAILURE_LOG}").filter(F.col("run_id") == run_id)
    return gate_summary(logged, n_typed)
