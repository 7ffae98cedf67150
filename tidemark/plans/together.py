"""Independent steps of a run at the same time, on a few driver threads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


class StepsFailed(RuntimeError):
    """Some steps failed or could not start; the others have ended. ``errors`` has them by name."""

    def __init__(self, errors: Mapping[str, BaseException]) -> None:
        self.errors = dict(errors)
        listed = "; ".join(f"{name}: {type(error).__name__}: {str(error)[:500]}" for name, error in self.errors.items())
        super().__init__(f"{len(self.errors)} steps failed: {listed}")


class NotStarted(RuntimeError):
    """A step that waits for a failed one."""


@dataclass(frozen=True)
class Step:
    name: str
    work: Callable[[], object]
    after: Sequence[str] = ()


def run_together(spark: SparkSession, steps: Sequence[Step], workers: int = 4) -> dict[str, object]:
    """Run steps, each after those it names (which must be listed before it); results by name.

    Spark shares its executors between the steps' jobs; in fair scheduling mode
    every step has a pool of its own. A failed step does not stop others, only
    those that wait for it. All errors are raised together at the end.
    """
    running: dict[str, Future] = {}

    def perform(step: Step) -> object:
        failed = [name for name in step.after if running[name].exception() is not None]  # waits
        if failed:
            raise NotStarted(f"waits for {', '.join(failed)}")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", step.name)
        return step.work()

    # Steps start in the order listed, so one that waits never holds up one it waits for.
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        for step in steps:
            running[step.name] = pool.submit(inheritable_thread_target(spark)(perform), step)
    errors = {name: done.exception() for name, done in running.items() if done.exception() is not None}
    if errors:
        raise StepsFailed(errors) from next(iter(errors.values()))
    return {name: done.result() for name, done in running.items()}
