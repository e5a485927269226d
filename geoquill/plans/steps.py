"""Resumable step lists: each step's result is a table, and the manifest says how far a run came."""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Category:
    """One class of features: its operations by name, whether it may be edited, and its place."""

    title: str
    operations: list[str]
    order: int
    accessible: bool = True
    reinsert: bool = False
    last: str | None = None
    done: int = 0


@dataclass
class Pipeline:
    """Named functions DataFrame -> DataFrame, run in order under root; finished steps are read back, not run again."""

    spark: SparkSession
    root: str
    steps: list[tuple[str, Callable]] = field(default_factory=list)

    def _finished(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def run(self, df: DataFrame) -> DataFrame:
        for i, (name, step) in enumerate(self.steps):
            path = f"{self.root}/{i:03d}-{name}"
            if not self._finished(path):
                step(df).write.mode("overwrite").parquet(path)
            df = self.spark.read.parquet(path)
        return df

    def done(self) -> int:
        return next((i for i, (name, _) in enumerate(self.steps) if not self._finished(f"{self.root}/{i:03d}-{name}")), len(self.steps))


def dispatch(registry: dict[str, Callable], name: str, **known) -> object:
    """Call a registered operation with the arguments that it names."""
    if name not in registry:
        raise KeyError(f"no operation {name}")
    return registry[name](**{k: v for k, v in known.items() if k in inspect.signature(registry[name]).parameters})


def edit_categories(df: DataFrame, categories: list[Category], registry: dict[str, Callable], column: str = "category") -> DataFrame:
    """Apply each category's operations to its rows, in order; edited categories are locked for those after.

    An operation gets (df, title, locked) and returns the whole table.
    """
    locked: list[str] = [c.title for c in categories if not c.accessible]
    for c in sorted((c for c in categories if c.accessible), key=lambda c: (c.order, c.title)):
        for op in c.operations[c.done :]:
            df = dispatch(registry, op, df=df, title=c.title, locked=list(locked), column=column)
        locked.append(c.title)
    return df


def recolour(df: DataFrame, title: str, into: str, column: str = "category") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == title, into).otherwise(F.col(column)))


class History:
    """How far a category run came: numbered JSON texts under root, of which the newest finished one counts.

    A new state is a new text, so a run that dies while it writes leaves the state
    before it. Keys that a state hasn't are None.
    """

    EMPTY = {"newest_version": None, "preprocessing_operations_completed": 0, "category_history": []}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _newest(self) -> int:
        p, fs = self._path(self.root)
        if not fs.exists(p):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return max((int(n) for n in names if n.isdigit() and fs.exists(self._path(f"{self.root}/{n}/_SUCCESS")[0])), default=0)

    def read(self) -> dict:
        n = self._newest()
        return json.loads(self.spark.read.text(f"{self.root}/{n:06d}").first()[0]) if n else dict(self.EMPTY)

    def get(self, key: str, title: str | None = None) -> object:
        """A value of the run, or of the category with this title."""
        state = self.read()
        if title is not None:
            state = next((c for c in state["category_history"] if c["title"] == title), {})
        return state.get(key)

    def write(self, state: dict) -> None:
        self.spark.createDataFrame([(json.dumps(state, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/{self._newest() + 1:06d}")

    def update(self, title: str | None = None, **values) -> None:
        """New values of the run, or of the category with this title, which must be there."""
        state = self.read()
        own = state if title is None else next(c for c in state["category_history"] if c["title"] == title)
        own.update(values)
        self.write(state)

    def reset(self) -> None:
        self.write(dict(self.EMPTY))

    def save_categories(self, categories: list[Category]) -> None:
        self.update(category_history=[asdict(c) for c in categories])

    def restore(self) -> list[Category]:
        """The categories as the run left them; none without a history."""
        known = {f.name for f in fields(Category)}
        return [Category(**{k: v for k, v in c.items() if k in known}) for c in self.read()["category_history"]]


def run_categories(cells: DataFrame, categories: list[Category], registry: dict[str, Callable], history: History, root: str) -> DataFrame:
    """Edit the categories of grid cells (id, col, row, category) one after the other; cells of finished or locked ones may not change.

    An operation gets own (the category's cells), locked and cells, as it names
    them, and returns the cells (id, col, row) that the category shall have. With
    reinsert the result loses its locked cells, without it overrides them too; cells
    that it leaves out keep their category. Each operation's result and each table
    is written, then noted in the history, so a run that is started again goes on
    after the last one; categories without cells or operations are just locked.
    """
    if not history.read()["category_history"]:
        history.save_categories(categories)
    spark = cells.sparkSession
    if newest := history.get("newest_version"):
        cells = spark.read.parquet(newest)
    for c in sorted(history.restore(), key=lambda c: (c.order, c.title)):
        if not c.accessible:
            continue
        closed = [x.title for x in history.restore() if not x.accessible]
        locked = cells.where(F.col("category").isin(closed))
        own, path = spark.read.parquet(c.last) if c.last else cells.where(F.col("category") == c.title), None
        if c.operations and not own.isEmpty():
            for i, op in enumerate(c.operations[c.done :], c.done + 1):
                path = f"{root}/{c.order:03d}-{c.title}-{i:03d}"
                dispatch(registry, op, own=own, locked=locked, cells=cells).select("id", "col", "row").write.mode("overwrite").parquet(path)
                history.update(c.title, last=path, done=i)
                own = spark.read.parquet(path)
            taken = own.select("id").distinct()
            if c.reinsert:
                taken = taken.join(locked.select("id"), "id", "left_anti")
            taken = taken.withColumn("_t", F.lit(c.title))
            path = f"{root}/{c.order:03d}-{c.title}"
            cells.join(taken, "id", "left").withColumn("category", F.coalesce("_t", "category")).drop("_t").write.mode("overwrite").parquet(path)
            cells = spark.read.parquet(path)
        # table and lock are noted at once: nothing is written over what it was read from
        state = history.read()
        next(x for x in state["category_history"] if x["title"] == c.title)["accessible"] = False
        history.write(state | ({"newest_version": path} if path else {}))
    return cells
