"""Registry of queries and lazy access to the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

RUN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables as attributes: ``t.orders``, ``t.customer`` and so on.

    Frames are plans, not data: each is described once per session and folder
    and shared by the queries, nothing is cached.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.frames: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self.frames:
            self.frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.frames[name]


_OPENED: dict[tuple[str, int, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    # A session's frames die with its application, and Python may give its id to another one.
    key = (spark.sparkContext.applicationId, id(spark), folder)
    if key not in _OPENED or _OPENED[key].spark is not spark:
        _OPENED[key] = Tables(spark, folder)
    return _OPENED[key]


def described_once(function: Callable[..., DataFrame]):
    """Share the plan of a derived frame between the queries of a session."""
    @functools.wraps(function)
    def shared(t: Tables, *args) -> DataFrame:
        key = (function.__module__, function.__name__, args)
        if key not in t.frames:
            t.frames[key] = function(t, *args)
        return t.frames[key]

    return shared


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with its SQL when there is one."""
    def keep(function: Callable[[Tables], DataFrame]):
        RUN[name] = lambda spark, folder: function(tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return function

    return keep
