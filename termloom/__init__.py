"""Student term histories on Spark: dated event rows in, one row per student and term out."""

from termloom.config import Config
from termloom.plans.student_history import student_term_history
from termloom.sources import Sources

__all__ = ["Config", "Sources", "student_term_history"]
