"""Report and BI exports."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from ebbtide.operators import reports


def report_frames(cube: DataFrame) -> dict[str, DataFrame]:
    """The seven reports, rolled up from the segment cube."""
    return {
        "geography_churn": reports.CHURN_BY_GEOGRAPHY.of_cube(cube),
        "age_churn": reports.CHURN_BY_AGE_GROUP.of_cube(cube),
        "product_churn": reports.CHURN_BY_PRODUCTS.of_cube(cube),
        "balance_churn": reports.balance_by_exited_of_cube(cube),
        "credit_score_churn": reports.CHURN_BY_CREDIT_BAND.of_cube(cube),
        "active_member_churn": reports.CHURN_BY_ACTIVE.of_cube(cube),
        "tenure_churn": reports.CHURN_BY_TENURE.of_cube(cube),
    }


def summary_frames(cube: DataFrame) -> dict[str, DataFrame]:
    return {
        "geography_summary": reports.GEOGRAPHY_SUMMARY.of_cube(cube),
        "age_summary": reports.AGE_SUMMARY.of_cube(cube),
        "product_summary": reports.PRODUCT_SUMMARY.of_cube(cube),
        "credit_score_summary": reports.CREDIT_SCORE_SUMMARY.of_cube(cube),
    }


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header. One file only for a report, whose rows are few."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def _write_side_by_side(frames: dict[str, DataFrame], folder: str) -> None:
    """One small file each; the jobs are short, so several run at a time."""
    spark = next(iter(frames.values())).sparkSession
    write = inheritable_thread_target(spark)(lambda named: write_csv(named[1], f"{folder}/{named[0]}", single=True))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, frames.items()))


def export_reports(customers: DataFrame, folder: str) -> list[str]:
    cube = reports.segment_cube(customers).persist()
    frames = report_frames(cube)
    _write_side_by_side(frames, folder)
    cube.unpersist()
    return list(frames)


def export_bi(customers: DataFrame, folder: str, metrics: DataFrame | None = None) -> list[str]:
    """Master table in as many files as it has parts, summaries in one each, metrics if measured."""
    write_csv(customers, f"{folder}/churn_master")
    cube = reports.segment_cube(customers).persist()
    frames = summary_frames(cube)
    if metrics is not None:
        frames["model_metrics"] = metrics
    _write_side_by_side(frames, folder)
    cube.unpersist()
    return ["churn_master", *frames]


def export_history(predictions: DataFrame, path: str) -> None:
    write_csv(predictions, path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_splits(split: DataFrame, path: str) -> None:
    """Rows with their `split`, in a folder per part, so a reader of one part reads no other."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
