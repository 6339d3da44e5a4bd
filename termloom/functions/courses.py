"""Predicates over course rows. A NULL in a tested column makes a predicate NULL, which counts as false."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.config import Config


def _own_course(cfg: Config) -> Column:
    return (
        (F.col("transaction_sts") != cfg.dropped_status)
        & ~F.col("grade_cde").isin(*cfg.transfer_grades)
        & (F.col("trm_cde") != cfg.transfer_term)
        & (F.col("yr_cde") != cfg.transfer_year)
    )


def valid_enrolment(cfg: Config) -> Column:
    """A credit course taken here: not dropped, not transferred, credit above zero."""
    return _own_course(cfg) & (F.col("credit_hrs") > 0)


def attempted_enrolment(cfg: Config) -> Column:
    """As :func:`valid_enrolment`, but by attempted hours instead of credit."""
    return _own_course(cfg) & (F.col("hrs_attempted") > 0)


def is_transfer(cfg: Config) -> Column:
    return (F.col("yr_cde") == cfg.transfer_year) | (F.col("trm_cde") == cfg.transfer_term)


def is_active(cfg: Config) -> Column:
    """A non-dropped credit course in one of the active terms."""
    return (
        (F.col("transaction_sts") != cfg.dropped_status)
        & (F.col("yr_cde") == cfg.active_year)
        & F.col("trm_cde").isin(*cfg.active_terms)
        & (F.col("credit_hrs") > 0)
    )


def credit_rank(cfg: Config) -> Column:
    """Rank of the credit type, NULL for an unlisted one."""
    rank = F.lit(None).cast("int")
    for code, value in cfg.credit_type_ranks.items():
        rank = F.when(F.col("credit_type_cde") == code, F.lit(value)).otherwise(rank)
    return rank
