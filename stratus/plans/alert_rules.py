"""The shipped alert rules, evaluated over samples and held for their required time.

Samples are ``(name, labels..., event_id, ts, value)``, one string column per label. The
rules name the labels ``instance`` (the host, job or container a sample is about), ``device``,
``mode`` and ``fstype``; every further one, such as a processor or a mount point, tells series
apart and stays in the result. The samples are first reduced to facts, a few rows per series and step: the last value, and
growth or changes over trailing windows. All rules read the facts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import epoch_micros, label_matches, seconds_between
from stratus.operators.absence import absence_periods
from stratus.operators.alerts import COMPARISONS, THRESHOLD_RULES
from stratus.operators.counters import counter_delta, value_changed
from stratus.operators.series import absent_series, recency
from stratus.operators.slices import over_windows, pairwise_steps, run_lengths, slice_number, step_end
from stratus.session import materialise

NOT_LABELS = {"name", "event_id", "ts", "value", "at", "measure"}
STACK = {"instance": "airflow.*|redis|minio|postgres"}
WINDOWS = {"5m": 300, "15m": 900, "1h": 3600}


@dataclass(frozen=True)
class Fact:
    """A measure of one metric: ``last``, ``growth_5m``, ``changes_15m`` and so on."""

    metric: str
    measure: str = "last"
    labels: dict[str, str] = field(default_factory=dict)
    without: dict[str, str] = field(default_factory=dict)

    def here(self) -> Column:
        hit = (F.col("name") == self.metric) & (F.col("measure") == self.measure)
        for label, pattern in self.labels.items():
            hit = hit & label_matches(label, pattern)
        for label, pattern in self.without.items():
            hit = hit & label_matches(label, pattern, negate=True)
        return hit


@dataclass(frozen=True)
class Named:
    alert: str
    hold: int
    severity: str
    component: str

    def row(self, truth: Column) -> Column:
        return F.struct(
            F.lit(self.alert).alias("alertname"), F.lit(self.severity).alias("severity"),
            F.lit(self.component).alias("component"), F.lit(self.hold).alias("hold_seconds"),
            F.coalesce(truth, F.lit(False)).alias("truth"),
        )


def _compare(value: Column, comparison: str, bound: float) -> Column:
    return COMPARISONS[comparison](value, F.lit(float(bound)))


# Rules over one fact, as (rule, fact, divisor, comparison, bound).
# Growth is compared as a rate where the divisor is the window in seconds.
SINGLE_RULES = tuple(
    (Named(r.alert, r.hold, r.severity, r.component), Fact(r.metric, labels=r.labels), 1, r.comparison, r.threshold)
    for r in THRESHOLD_RULES
) + (
    (Named("AirflowSchedulerDown", 120, "critical", "scheduler"),
     Fact("airflow_scheduler_heartbeat", "growth_5m"), 300, "==", 0),
    (Named("AirflowHighTaskFailureRate", 300, "warning", "worker"),
     Fact("airflow_ti_failures", "growth_15m"), 900, ">", 0.1),
    (Named("AirflowZombiesDetected", 0, "warning", "scheduler"),
     Fact("airflow_zombies_killed", "growth_1h"), 1, ">", 0),
    (Named("PrometheusTooManyRestarts", 0, "warning", "monitoring"),
     Fact("process_start_time_seconds", "changes_1h", {"instance": "prometheus"}), 1, ">", 2),
)
# Age in seconds after which pushed data counts as stale.
STALE_RULE = (Named("PipelineDataStale", 600, "warning", "pipeline"), Fact("push_time_seconds"), 86_400)
# Share rules in percent, as (rule, part, whole, whether the rest is meant, bound).
REAL_DISKS = {"fstype": "tmpfs|overlay"}
SHARE_RULES = (
    (Named("ContainerHighMemory", 300, "warning", "container"),
     Fact("docker_container_memory_usage_bytes"), Fact("docker_container_memory_limit_bytes"), False, 85),
    (Named("HostHighMemory", 300, "warning", "host"),
     Fact("node_memory_MemAvailable_bytes"), Fact("node_memory_MemTotal_bytes"), True, 85),
    (Named("HostDiskSpaceLow", 300, "warning", "host"),
     Fact("node_filesystem_avail_bytes", without=REAL_DISKS), Fact("node_filesystem_size_bytes", without=REAL_DISKS),
     True, 85),
)
# Rules that need two conditions at once, as (rule, (fact, comparison, bound) twice).
CARDS = {"device": "lo|veth.*|docker.*|br-.*"}
PAIR_RULES = (
    (Named("ContainerRestarted", 0, "warning", "container"),
     (Fact("docker_container_restart_count", labels=STACK), ">", 0),
     (Fact("docker_container_start_time_seconds", "changes_15m", STACK), ">", 0)),
    (Named("HostNetworkDown", 180, "critical", "network"),
     (Fact("node_network_receive_bytes_total", "growth_5m", without=CARDS), "==", 0),
     (Fact("node_network_transmit_bytes_total", "growth_5m", without=CARDS), "==", 0)),
)
# Busy share of a host's processors, from idle time.
CPU_RULE = (
    Named("HostHighCPU", 300, "warning", "host"), Fact("node_cpu_seconds_total", "growth_5m", {"mode": "idle"}), 300, 85
)
# Series whose absence is itself an alert, as (rule, metric, instance), and the seconds after which a
# series without a sample counts as absent.
ABSENCE_RULES = (
    (Named("AirflowSchedulerDown", 120, "critical", "scheduler"), "airflow_scheduler_heartbeat", ""),
    (Named("LokiDown", 120, "warning", "monitoring"), "up", "loki"),
)
LOOKBACK = 300


def labels_of(rows: DataFrame) -> list[str]:
    """The label columns of samples or facts."""
    return [c for c in rows.columns if c not in NOT_LABELS]


def all_named() -> list[Named]:
    return [r[0] for r in (*SINGLE_RULES, STALE_RULE, *SHARE_RULES, *PAIR_RULES, CPU_RULE)]


def _facts_used() -> list[Fact]:
    facts = [r[1] for r in SINGLE_RULES] + [STALE_RULE[1], CPU_RULE[1]]
    facts += [f for r in SHARE_RULES for f in r[1:3]]
    return facts + [side[0] for r in PAIR_RULES for side in r[1:]]


def rule_facts(samples: DataFrame, step: float = 60) -> DataFrame:
    """Rows ``(name, labels, at, measure, value)``: at most three scans for all rules."""
    used = {(f.metric, f.measure) for f in _facts_used()}

    def metrics(kind: str) -> list[str]:
        return sorted({metric for metric, measure in used if measure.split("_")[0] == kind})

    keys = ["name", *labels_of(samples)]
    newest = samples.where(F.col("name").isin(metrics("last"))).groupBy(*keys, slice_number("ts", step).alias("_step"))
    parts = [
        newest.agg(F.max_by("value", recency("ts", "event_id")).alias("value")).select(
            *keys, step_end(F.col("_step"), step).alias("at"), F.lit("last").alias("measure"), "value"
        )
    ]
    for kind, contribution in (("growth", counter_delta), ("changes", value_changed)):
        spans = {
            f"{kind}_{span}": seconds for span, seconds in WINDOWS.items()
            if any(measure == f"{kind}_{span}" for _, measure in used)
        }
        chosen = samples.where(F.col("name").isin(metrics(kind)))
        steps = pairwise_steps(chosen, keys, "ts", "value", "event_id", contribution, step)
        wide = over_windows(steps, keys, step, spans)
        pairs = F.array(*[
            F.struct(F.lit(span).alias("measure"), F.col(span).cast("double").alias("value")) for span in spans
        ])
        long = wide.select(*keys, F.col("evaluated_at").alias("at"), F.inline(pairs))
        wanted = [(F.col("name") == m) & (F.col("measure") == k) for m, k in sorted(used) if k in spans]
        parts.append(long.where(reduce(lambda a, b: a | b, wanted)))
    return reduce(DataFrame.unionByName, parts)


def _single_truths(facts: DataFrame) -> DataFrame:
    rows = []
    for rule, fact, divisor, comparison, bound in SINGLE_RULES:
        truth = _compare(F.col("value") / F.lit(float(divisor)), comparison, bound)
        rows.append(F.when(fact.here(), rule.row(truth)))
    rule, fact, age = STALE_RULE
    rows.append(F.when(fact.here(), rule.row(epoch_micros("at") / F.lit(1e6) - F.col("value") > age)))
    hits = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return facts.select(*labels_of(facts), "at", F.inline(hits))


def _paired_truths(facts: DataFrame) -> DataFrame:
    """Rules over two facts of one series and step, side by side in one aggregate."""
    sides, rows = [], []

    def side(fact: Fact) -> Column:
        name = f"s{len(sides)}"
        # A fact without a value (too few samples) is still there: keep both apart.
        sides.append(F.max(F.when(fact.here(), F.struct("value"))).alias(name))
        return F.col(name)

    for rule, part, whole, rest, bound in SHARE_RULES:
        part, whole = side(part), side(whole)
        share = F.try_divide(part["value"], whole["value"])
        percent = ((1 - share) if rest else share) * 100
        rows.append(F.when(part.isNotNull() & whole.isNotNull(), rule.row(percent > bound)))
    for rule, *conditions in PAIR_RULES:
        found = [(side(fact), comparison, bound) for fact, comparison, bound in conditions]
        there = reduce(lambda a, b: a | b, [s.isNotNull() for s, _, _ in found])
        truth = reduce(lambda a, b: a & b, [_compare(s["value"], c, b) for s, c, b in found])
        rows.append(F.when(there, rule.row(truth)))
    hits = F.filter(F.array(*rows), lambda r: r.isNotNull())
    labels = labels_of(facts)
    return facts.groupBy(*labels, "at").agg(*sides).select(*labels, "at", F.inline(hits))


def _processor_truths(facts: DataFrame) -> DataFrame:
    """A host's processors are series of their own; their mean is taken after the growth of each."""
    rule, fact, window, bound = CPU_RULE
    idle = facts.where(fact.here()).groupBy("instance", "at").agg(F.avg(F.col("value") / F.lit(float(window))).alias("idle"))
    busy = F.lit(100.0) - F.col("idle") * 100
    labels = [F.col(c) if c == "instance" else F.lit(None).cast("string").alias(c) for c in labels_of(facts)]
    known = idle.where(F.col("idle").isNotNull())
    return known.select(*labels, "at", F.inline(F.array(rule.row(busy > bound))))


def rule_truths(facts: DataFrame) -> DataFrame:
    """Truth of every rule for every series it applies to, at each step the series reported."""
    return _single_truths(facts).unionByName(_paired_truths(facts)).unionByName(_processor_truths(facts))


def held_rule_alerts(samples: DataFrame, step: float = 60, slice_seconds: float = 86_400) -> DataFrame:
    """Periods in which a rule was true long enough, for all rules in one pass, as far as their series report.

    The facts feed several branches and are stored once; they hold a few rows
    per series and step, whatever the number of samples.
    """
    facts = materialise(rule_facts(samples, step), "rule_facts")
    keys = ["alertname", "severity", "component", "hold_seconds", *labels_of(samples)]
    runs = run_lengths(rule_truths(facts), keys, "at", F.col("truth"), "at", slice_seconds)
    held = seconds_between("started_at", "ended_at")
    return runs.where(F.col("state") & (held >= F.col("hold_seconds"))).select(
        "alertname", "severity", "component", *labels_of(samples), "started_at", "ended_at", "samples"
    )


def _expected(samples: DataFrame) -> DataFrame:
    rows = [(r.alert, r.severity, r.component, r.hold, name, instance) for r, name, instance in ABSENCE_RULES]
    return samples.sparkSession.createDataFrame(
        rows, "alertname string, severity string, component string, hold_seconds int, name string, instance string"
    )


def _watched(samples: DataFrame) -> DataFrame:
    """Samples of the series that absence rules name; where no instance is named, any one counts."""
    any_instance = F.col("name").isin([name for _, name, instance in ABSENCE_RULES if not instance])
    one_instance = reduce(
        lambda a, b: a | b,
        [(F.col("name") == name) & (F.col("instance") == instance) for _, name, instance in ABSENCE_RULES if instance],
    )
    seen = samples.where(one_instance | any_instance)
    return seen.withColumn("instance", F.when(any_instance, F.lit("")).otherwise(F.col("instance")))


def held_absences(samples: DataFrame, step: float = 60, lookback_seconds: float = LOOKBACK) -> DataFrame:
    """Periods in which a series named by an absence rule had no sample, held for the rule's time.

    Rules are evaluated at the ends of all steps from the first sample of any series to the last one; a series that
    stops is thus seen as long as others go on. An absence has no labels but the instance its rule names.
    """
    first, last = samples.agg(F.min("ts"), F.max("ts")).first()
    keys = ["name", "instance"]
    columns = ["alertname", "severity", "component", *labels_of(samples), "started_at", "ended_at", "evaluations"]
    rules = _expected(samples)
    if first is None:  # without any sample there was no evaluation
        first = last = datetime(1970, 1, 1)
        rules = rules.limit(0)
    since, until = (step_end(slice_number(F.lit(t).cast("timestamp_ntz"), step), step) for t in (first, last))
    gone = absence_periods(_watched(samples), keys, since, until, lookback_seconds, step, expected=rules)
    held = seconds_between("started_at", "ended_at")
    named = gone.join(F.broadcast(rules), keys).where(held >= F.col("hold_seconds"))  # one row per rule
    labels = {c: F.lit(None).cast(samples.schema[c].dataType) for c in labels_of(samples) if c != "instance"}
    return named.withColumns({**labels, "instance": F.nullif("instance", F.lit(""))}).select(*columns)


def all_rule_alerts(samples: DataFrame, step: float = 60, slice_seconds: float = 86_400) -> DataFrame:
    """``held_rule_alerts`` and ``held_absences`` together: everything the shipped rules fire."""
    gone = held_absences(samples, step).withColumnRenamed("evaluations", "samples")
    return held_rule_alerts(samples, step, slice_seconds).unionByName(gone)


def absence_alerts(samples: DataFrame, now: Column, lookback_seconds: float = LOOKBACK) -> DataFrame:
    """Rules whose series has no sample in the lookback before ``now``, whether held or not."""
    expected = _expected(samples).select("alertname", "name", "instance")
    return absent_series(expected, _watched(samples), ["name", "instance"], now, lookback_seconds).drop("value")
