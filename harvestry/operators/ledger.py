"""Task states: current state, open tasks, recovery and illegal moves."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.operators.ordering import keep_last, with_previous
from harvestry.specs import words


def move_allowed(before: Column, after: Column, moves: Sequence[tuple[str, str]] = words.ALLOWED_MOVES) -> Column:
    return reduce(lambda a, b: a | b, [(before == x) & (after == y) for x, y in moves])


def transition_check(history: DataFrame, task: str, order: Sequence[str], status: str,
                     moves: Sequence[tuple[str, str]] = words.ALLOWED_MOVES) -> DataFrame:
    """Rows whose status may not follow the one before it."""
    linked = with_previous(history, [task], order, status, "previous_status")
    return linked.filter(F.col("previous_status").isNotNull() & ~move_allowed(F.col("previous_status"), F.col(status), moves))


def latest_status(history: DataFrame, task: str, order: Sequence[str]) -> DataFrame:
    """Current row per task."""
    return keep_last(history, [task], order)


def unfinished(tasks: DataFrame, status: str, order: Sequence[str], terminal: Sequence[str] = words.TERMINAL_STATES) -> DataFrame:
    """Tasks in no final state, oldest first."""
    return tasks.filter(~F.col(status).isin(*terminal)).orderBy(*order)


def recovery_steps(status: Column) -> Column:
    """States written when a task is put back: running goes through the retry state, waiting kinds go straight to the queue."""
    return (F.when(status == "running", F.array(F.lit("waiting_retry"), F.lit("queued")))
            .when(status.isin("pending", "waiting_retry", "blocked"), F.array(F.lit("queued")))
            .when(status == "queued", F.array().cast("array<string>")))


def recover(tasks: DataFrame, task: str, status: str) -> tuple[DataFrame, DataFrame]:
    """(tasks put into the queue, history rows written for it)."""
    open_tasks = tasks.withColumn("_steps", recovery_steps(F.col(status))).filter(F.col("_steps").isNotNull())
    history = open_tasks.select(task, F.posexplode("_steps").alias("step", "new_status"))
    return open_tasks.drop("_steps").withColumn(status, F.lit("queued")), history


def rank_label(position: Column, name: Column, ranks: Sequence[str] = words.RANK_WORDS) -> Column:
    """Spelled-out rank up to the tenth, a number after that."""
    spelled = reduce(lambda acc, iw: acc.when(position == iw[0], iw[1]), enumerate(ranks, 1), F.when(F.lit(False), ""))
    prefix = F.coalesce(spelled, F.concat(F.lit("第"), position.cast("string")))
    return F.concat(prefix, F.lit("候选人："), name)


def rank_labels(names: Column, ranks: Sequence[str] = words.RANK_WORDS) -> Column:
    """Labels for an ordered name list."""
    from harvestry.functions.text import collapse

    return F.transform(names, lambda n, i: rank_label(i + 1, collapse(n), ranks))
