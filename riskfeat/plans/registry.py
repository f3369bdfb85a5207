"""Feature views, runs and model versions, next to their data.

Each change is one commit, and the last one per name and version counts. Nothing is rewritten, so a
job that dies leaves what was there before, and of two writers none loses its entry.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskfeat.operators.features import FeatureView
from riskfeat.plans.boosting import BoostedTrees
from riskfeat.sources.commits import CommitLog
from riskfeat.sources.files import write_partitioned

ENTRY = (
    "kind string, name string, version string, state string, at long, "
    "path string, signature array<string>, metrics map<string,double>, detail map<string,string>"
)


def _newest(entries: list[dict]) -> list[dict]:
    """The last entry of every kind, name and version, in order."""
    last = {(e["kind"], e["name"], e["version"]): e["number"] for e in entries}
    return [e for e in entries if last[e["kind"], e["name"], e["version"]] == e["number"]]


class Registry:
    """Names and versions below one environment root, such as a dev or a prod folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._commits = CommitLog(spark, f"{self.root}/registry", _newest)

    def _log(self, kind: str, name: str, version: str, state: str, **fields) -> None:
        self._commits.append(lambda _: {"kind": kind, "name": name, "version": version, "state": state, **fields})

    def entries(self, kind: str) -> DataFrame:
        """The last entry per name and version of one kind, deleted ones left out; ``at`` is its place in the log."""
        newest = {}
        for entry in self._commits.entries():
            if entry["kind"] == kind:
                newest[entry["name"], entry["version"]] = {"at": entry["number"], **entry}
        names = [f.split()[0] for f in ENTRY.split(", ")]
        rows = [[e.get(c) for c in names] for e in newest.values() if e["state"] != "deleted"]
        return self.spark.createDataFrame(rows, ENTRY)

    def _entry(self, kind: str, name: str, version: str):
        found = self.entries(kind).where(
            (F.col("name") == name) & (F.upper("version") == version.upper())
        ).orderBy(F.desc(F.col("version") == version)).first()
        if found is None:
            raise KeyError(f"{kind} {name}/{version} is not registered in {self.root}")
        return found

    # -- feature views --

    def refresh(self, view: FeatureView, source: DataFrame, overwrite: bool = True) -> DataFrame:
        """Compute a view from its source and make the result its current rows."""
        found = self.entries("view").where(
            (F.col("name") == view.name) & (F.col("version") == view.version)
        )
        if not overwrite and found.first() is not None:
            raise ValueError(f"view {view.name}/{view.version} exists")
        path = f"{self.root}/views/{view.name}/{view.version}/{uuid.uuid4().hex}"
        view.rows(source).write.parquet(path)
        detail = {"keys": ",".join(view.entity.keys), "ts": view.ts or "", "refresh": view.refresh}
        self._log("view", view.name, view.version, "live", path=path, detail=detail)
        return self.spark.read.parquet(path)

    register = refresh

    def view(self, name: str, version: str) -> DataFrame:
        return self.spark.read.parquet(self._entry("view", name, version)["path"])

    def delete_view(self, name: str, version: str) -> None:
        self._log("view", name, self._entry("view", name, version)["version"], "deleted")

    # -- runs --

    def log_run(self, run: str, params: Mapping[str, object], metrics: Mapping[str, float]) -> None:
        """One run; a run of the same name is replaced."""
        row = [(run, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})]
        schema = "run string, params map<string,string>, metrics map<string,double>"
        write_partitioned(self.spark.createDataFrame(row, schema), f"{self.root}/runs", ["run"])

    def runs(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/runs")

    # -- models --

    def log_model(
        self,
        model: PipelineModel | BoostedTrees,
        name: str,
        version: str,
        signature: Sequence[str],
        metrics: Mapping[str, float],
    ) -> None:
        path = f"{self.root}/models/{name}/{version}/{uuid.uuid4().hex}"
        kind = type(model).__name__
        if isinstance(model, BoostedTrees):
            model.save(self.spark, path)
        else:
            model.save(path)
        self._log(
            "model", name, version, "live",
            path=path, signature=list(signature), metrics=dict(metrics), detail={"class": kind},
        )

    def versions(self, name: str) -> list[str]:
        rows = self.entries("model").where(F.col("name") == name).orderBy("at").collect()
        return [r["version"] for r in rows]

    def has_version(self, name: str, version: str) -> bool:
        return version.upper() in [v.upper() for v in self.versions(name)]

    def resolve(self, name: str, version: str) -> str:
        """The version as it was registered, whatever its case here."""
        return self._entry("model", name, version)["version"]

    def model(self, name: str, version: str) -> tuple[PipelineModel | BoostedTrees, list[str], dict[str, float]]:
        """The model of a version with its input signature and metrics."""
        entry = self._entry("model", name, version)
        trees = (entry["detail"] or {}).get("class") == BoostedTrees.__name__
        model = BoostedTrees.load(self.spark, entry["path"]) if trees else PipelineModel.load(entry["path"])
        return model, list(entry["signature"]), dict(entry["metrics"])

    def set_default(self, name: str, version: str) -> None:
        found = self._entry("model", name, version)["version"]
        self._log("default", name, "default", "live", detail={"version": found})

    def default(self, name: str) -> str:
        return self._entry("default", name, "default")["detail"]["version"]

    def delete_version(self, name: str, version: str) -> None:
        version = self._entry("model", name, version)["version"]
        chosen = self.entries("default").where(F.col("name") == name).first()
        if chosen is not None and chosen["detail"]["version"] == version:
            raise ValueError(f"{name}/{version} is the default; choose another first")
        self._log("model", name, version, "deleted")

    def drop_model(self, name: str) -> None:
        """Take down a model with all its versions, as a reset does."""
        if self.entries("default").where(F.col("name") == name).first() is not None:
            self._log("default", name, "default", "deleted")
        for version in self.versions(name):
            self._log("model", name, version, "deleted")

    def missing(self, views: Sequence[tuple[str, str]], models: Sequence[tuple[str, str]]) -> list[str]:
        """What a run would still need: views and models that are not registered."""
        have = {
            kind: {(r["name"], r["version"]) for r in self.entries(kind).collect()}
            for kind in ("view", "model")
        }
        return [f"view {n}/{v}" for n, v in views if (n, v) not in have["view"]] + [
            f"model {n}/{v}" for n, v in models if (n, v) not in have["model"]
        ]
