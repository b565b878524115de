"""Dotted metric names to labelled metrics, by ordered glob rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pattern, metric name, names of the labels its stars stand for.
# A star is one dot-separated segment; the first matching rule wins.
METRIC_RULES = (
    ("airflow.scheduler.heartbeat", "airflow_scheduler_heartbeat", ()),
    ("airflow.scheduler.orphaned_tasks.cleared", "airflow_scheduler_orphaned_tasks_cleared", ()),
    ("airflow.scheduler.orphaned_tasks.adopted", "airflow_scheduler_orphaned_tasks_adopted", ()),
    ("airflow.scheduler.critical_section_busy", "airflow_scheduler_critical_section_busy", ()),
    ("airflow.scheduler.tasks.killed_externally", "airflow_scheduler_tasks_killed_externally", ()),
    ("airflow.scheduler.tasks.running", "airflow_scheduler_tasks_running", ()),
    ("airflow.scheduler.tasks.starving", "airflow_scheduler_tasks_starving", ()),
    ("airflow.scheduler.tasks.executable", "airflow_scheduler_tasks_executable", ()),
    ("airflow.dag_processing.total_parse_time", "airflow_dag_processing_total_parse_time", ()),
    ("airflow.dag_processing.processes", "airflow_dag_processing_processes", ()),
    ("airflow.dag_processing.processor_timeouts", "airflow_dag_processing_processor_timeouts", ()),
    ("airflow.dag_processing.import_errors", "airflow_dag_processing_import_errors", ()),
    ("airflow.dag_processing.file_path_queue_size", "airflow_dag_processing_file_path_queue_size", ()),
    ("airflow.dagrun.duration.success.*", "airflow_dagrun_duration_success", ("dag_id",)),
    ("airflow.dagrun.duration.failed.*", "airflow_dagrun_duration_failed", ("dag_id",)),
    ("airflow.dagrun.schedule_delay.*", "airflow_dagrun_schedule_delay", ("dag_id",)),
    ("airflow.dagrun.*.first_task_scheduling_delay", "airflow_dagrun_first_task_scheduling_delay", ("dag_id",)),
    ("airflow.dagrun.dependency-check.*", "airflow_dagrun_dependency_check", ("dag_id",)),
    ("airflow.dag.*.*.duration", "airflow_task_duration", ("dag_id", "task_id")),
    ("airflow.dag.*.*.queued_duration", "airflow_task_queued_duration", ("dag_id", "task_id")),
    ("airflow.dag.*.*.scheduled_duration", "airflow_task_scheduled_duration", ("dag_id", "task_id")),
    ("airflow.ti.start.*.*", "airflow_ti_start", ("dag_id", "task_id")),
    ("airflow.ti.finish.*.*.*", "airflow_ti_finish", ("dag_id", "task_id", "state")),
    ("airflow.ti_failures", "airflow_ti_failures", ()),
    ("airflow.ti_successes", "airflow_ti_successes", ()),
    ("airflow.executor.open_slots", "airflow_executor_open_slots", ()),
    ("airflow.executor.queued_tasks", "airflow_executor_queued_tasks", ()),
    ("airflow.executor.running_tasks", "airflow_executor_running_tasks", ()),
    ("airflow.pool.open_slots.*", "airflow_pool_open_slots", ("pool",)),
    ("airflow.pool.queued_slots.*", "airflow_pool_queued_slots", ("pool",)),
    ("airflow.pool.running_slots.*", "airflow_pool_running_slots", ("pool",)),
    ("airflow.pool.starving_tasks.*", "airflow_pool_starving_tasks", ("pool",)),
    ("airflow.pool.deferred_slots.*", "airflow_pool_deferred_slots", ("pool",)),
    ("airflow.celery.task_timeout_error", "airflow_celery_task_timeout_error", ()),
    ("airflow.celery.execute_command.failure", "airflow_celery_execute_command_failure", ()),
    ("airflow.zombies_killed", "airflow_zombies_killed", ()),
    ("airflow.sla_missed", "airflow_sla_missed", ()),
    ("airflow.sla_callback_count", "airflow_sla_callback_count", ()),
    ("airflow.*", "airflow_unmapped", ("statsd_metric",)),
)
UNMAPPED = "unmapped"


def _lookup(entries: dict[str, int], key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
    return F.try_element_at(table, key)


def with_metric_name(df: DataFrame, dotted: str, into: str = "mapped", rules=METRIC_RULES) -> DataFrame:
    """Add a struct of ``name`` and ``labels`` for a dotted metric name.

    Rules are data: patterns with stars at the same places form one table, and
    a name is looked up with those places starred out. The smallest rule number
    found is the first match. A row costs one lookup per table, so the
    generated code does not grow with the number of rules.
    """
    tables: dict[tuple[int, tuple[int, ...]], dict[str, int]] = {}
    for number, (pattern, _, _) in enumerate(rules):
        segments = pattern.split(".")
        stars = tuple(i for i, s in enumerate(segments) if s == "*")
        tables.setdefault((len(segments), stars), {}).setdefault(pattern, number)
    found = [F.lit(None).cast("int"), F.lit(None).cast("int")]
    exact: dict[str, int] = {}
    for (length, stars), entries in tables.items():
        if not stars:
            exact |= entries
            continue
        starred = [F.lit("*") if i in stars else F.get("_parts", F.lit(i)) for i in range(length)]
        key = F.when(F.size("_parts") == length, F.concat_ws(".", *starred))
        found.append(_lookup(entries, key))
    if exact:
        found.append(_lookup(exact, F.col(dotted)))
    names = F.lit([name for _, name, _ in rules])
    label_names = F.array(*[F.lit(list(labels)).cast("array<string>") for _, _, labels in rules])
    places = F.array(*[
        F.lit([i for i, s in enumerate(pattern.split(".")) if s == "*"]).cast("array<int>") for pattern, _, _ in rules
    ])
    labels = F.map_from_arrays(
        F.get(label_names, F.col("_rule")), F.transform(F.get(places, F.col("_rule")), lambda i: F.get("_parts", i))
    )
    mapped = F.struct(
        F.coalesce(F.get(names, F.col("_rule")), F.lit(UNMAPPED)).alias("name"),
        F.coalesce(labels, F.create_map().cast("map<string,string>")).alias("labels"),
    )
    split = df.withColumn("_parts", F.split(dotted, "\\.")).withColumn("_rule", F.least(*found))
    return split.withColumn(into, mapped).drop("_parts", "_rule")
