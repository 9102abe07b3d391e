"""Versioned snapshots of several tables, committed at once.

A commit writes the changed tables under new version folders, then replaces one small file that names the version of
every table.  Readers see all of a commit or nothing of it.  One writer at a time, by a lock file; migrations and audit
rows are tables like others.  Meant for folders with atomic rename.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        os.makedirs(root, exist_ok=True)

    def current(self) -> dict:
        try:
            with open(f"{self.root}/CURRENT") as f:
                return json.load(f)
        except FileNotFoundError:
            return {"version": 0, "tables": {}, "migrations": {}}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self.current()['tables'][name]}")

    @contextlib.contextmanager
    def lock(self) -> Iterator[None]:
        path = f"{self.root}/LOCK"
        handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)  # fails if another writer is at work
        try:
            yield
        finally:
            os.close(handle)
            os.unlink(path)

    def _replace(self, state: dict) -> None:
        part = f"{self.root}/.CURRENT-{uuid.uuid4().hex}"
        with open(part, "w") as f:
            json.dump(state, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, f"{self.root}/CURRENT")

    def commit(self, tables: dict[str, DataFrame], dry_run: bool = False, migration: tuple[str, str] | None = None) -> int:
        """The new version; nothing is written in a dry run.

        The state is read under the lock, so no other writer's commit is lost.  A migration is recorded by the same
        replacement that shows its tables.
        """
        if dry_run:
            return self.current()["version"]
        with self.lock():
            state = self.current()
            state["version"] += 1
            for name, df in tables.items():
                at = f"{name}/v={state['version']}-{uuid.uuid4().hex[:8]}"
                df.write.parquet(f"{self.root}/{at}")
                state["tables"][name] = at
            if migration:
                state["migrations"][migration[0]] = migration[1]
            self._replace(state)
        return state["version"]

    def migrate(self, steps: list[tuple[str, str, Callable[["Store"], dict[str, DataFrame]]]]) -> list[str]:
        """Steps (version, source text, function), each once and in order; a changed source of a done step is an error."""
        done = []
        for version, source, step in steps:
            mark = hashlib.sha256(source.encode()).hexdigest()
            known = self.current()["migrations"].get(version)
            if known and known != mark:
                raise ValueError(f"migration {version} has changed since it was applied")
            if not known:
                self.commit(step(self), migration=(version, mark))
                done.append(version)
        return done


class Pipeline:
    """Named stages over a state of tables; a failed fatal stage ends the run, another is reported."""

    def __init__(self, stages: list[tuple[str, Callable[[dict[str, DataFrame]], dict[str, DataFrame]]]], fatal: set[str] = frozenset()):
        self.stages, self.fatal = stages, fatal

    def run(self, state: dict[str, DataFrame], only: set[str] | None = None) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
        log = []
        for name, stage in self.stages:
            if only is not None and name not in only:
                log.append((name, "skipped"))
                continue
            try:
                state = {**state, **stage(state)}
                log.append((name, "ok"))
            except Exception as e:  # noqa: BLE001
                log.append((name, f"failed: {e}"))
                if name in self.fatal:
                    break
        return state, log
