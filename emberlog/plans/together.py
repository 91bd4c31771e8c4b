"""Independent jobs at the same time."""

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

CANCEL_EVERY_SECONDS = 0.2


def run_together(spark: SparkSession, jobs: dict[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run all jobs at once and return their results by name.

    Each job's actions go to a scheduler pool of its name, which share the cores evenly under
    `spark.scheduler.mode=FAIR`; otherwise a job takes what earlier ones leave. One gzip file is
    one task, so logs that wait for each other leave most cores idle. The first error cancels
    what the others are running and is raised once all have ended.
    """
    if not jobs:
        return {}
    context = spark.sparkContext
    tag = f"emberlog-{uuid.uuid4().hex}"

    def run(name: str, job: Callable[[], Result]) -> Result:
        context.setLocalProperty("spark.scheduler.pool", name)
        context.addJobTag(tag)
        return job()

    with ThreadPoolExecutor(len(jobs)) as threads:
        running = {name: threads.submit(inheritable_thread_target(spark)(run), name, job) for name, job in jobs.items()}
        done, open_jobs = wait(running.values(), return_when=FIRST_EXCEPTION)
        failed = next((f for f in done if f.exception()), None)
        while failed and open_jobs:  # a job may be between two actions, so once isn't enough
            context.cancelJobsWithTag(tag)
            _, open_jobs = wait(open_jobs, CANCEL_EVERY_SECONDS)
    if failed:
        raise failed.exception()
    return {name: future.result() for name, future in running.items()}
