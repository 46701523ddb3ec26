"""Runs as named steps: in order, with retries, each timed; what failed stops what follows."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quarryline.plans.batch import Metrics, load_bronze, load_gold, load_silver, validate_lake
from quarryline.plans.config import Config
from quarryline.sources.readers import Watermarks

log = logging.getLogger("quarryline")


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable[[], object]
    retries: int = 0


class StepFailed(RuntimeError):
    """A step failed in all its attempts."""


def run_steps(steps: Sequence[Step], metrics: Metrics | None = None, pause: float = 1.0) -> dict[str, object]:
    """Results by step name; loads are merges or whole versions, so an attempt after a failed one is harmless."""
    metrics, done = metrics or Metrics(), {}
    for step in steps:
        for attempt in range(step.retries + 1):
            try:
                with metrics.timer("step", step=step.name, attempt=attempt):
                    done[step.name] = step.run()
                break
            except Exception as failure:
                log.warning("%s, attempt %d: %s", step.name, attempt, failure)
                if attempt == step.retries:
                    raise StepFailed(f"{step.name}: {failure}") from failure
                time.sleep(pause * 2**attempt)
    return done


def batch_steps(spark: SparkSession, config: Config, sources: Callable[[str], DataFrame], marks: Watermarks | None = None, retries: int = 2) -> list[Step]:
    """A batch run: a Bronze and a Silver step for every table, then Gold, then the checks."""

    def check() -> list:
        checks = validate_lake(spark, config)
        if failed := [c.name for c in checks if not c.passed]:
            raise RuntimeError("failed checks: " + ", ".join(failed))
        return checks

    bronze = [Step(f"bronze {t}", lambda t=t: load_bronze(spark, config, t, sources(t), marks), retries) for t in config.tables]
    silver = [Step(f"silver {t}", lambda t=t: load_silver(spark, config, t), retries) for t in config.tables]
    return [*bronze, *silver, Step("gold", lambda: load_gold(spark, config), retries), Step("validate", check)]
