"""Named queries over the test tables, each with the same question in SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession


class Data:
    """The Parquet tables of a folder as attributes; nothing is read until a column is used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet").alias(name)


Plan = Callable[[Data], DataFrame]


class Catalogue:
    def __init__(self) -> None:
        self.plans: dict[str, Plan] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str) -> Callable[[Plan], Plan]:
        """Register a function under its own name, with the SQL it is checked against."""

        def register(plan: Plan) -> Plan:
            if plan.__name__ in self.plans:
                raise ValueError(f"two queries are called {plan.__name__}")
            self.plans[plan.__name__] = plan
            self.sql[plan.__name__] = " ".join(sql.split())
            return plan

        return register

    def add(self, name: str, plan: Plan, sql: str) -> None:
        plan.__name__ = name
        self.query(sql)(plan)

    def runnable(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        def bound(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
            return lambda spark, folder: plan(Data(spark, folder))

        return {name: bound(plan) for name, plan in self.plans.items()}
