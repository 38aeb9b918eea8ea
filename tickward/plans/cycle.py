"""One turn of rule evaluation."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickward.functions.thresholds import unusable
from tickward.operators.latest import latest_per_key
from tickward.operators.retention import purge_flagged
from tickward.operators.rules import (
    OPERANDS,
    digest,
    evaluate_thresholds,
    fired_only,
    latest_ticks,
    mark_alerted,
    match_rules,
    pending_rules,
    render_notifications,
    threshold_rejects,
    without_alerted,
)
from tickward.schemas import RULE, RULE_KEY
from tickward.sources.commits import Commit, Log, commits, read_commits, read_folders, source_key, succeed, write_commit
from tickward.sources.files import stored
from tickward.sources.storage import CODEC, delete, entries, no_rows


@dataclass(frozen=True)
class Cycle:
    """What one evaluation gives: rows that fired, rows that could not be evaluated, and, built
    on demand, the notifications and the rules with the fired ones flagged."""

    fired: DataFrame
    rejects: DataFrame
    evaluated: DataFrame
    keys: Sequence[str]
    already: DataFrame | None = None

    @property
    def notifications(self) -> DataFrame:
        return render_notifications(self.fired)

    @property
    def rules(self) -> DataFrame:
        rules = self.evaluated if self.already is None else mark_alerted(self.evaluated, self.already, self.keys)
        return mark_alerted(rules, self.fired, self.keys)


# What a row that cannot be evaluated is told apart by: the rule with its tick, and the price it met.
REJECTED_RULE = ["chat_id", "crypto_type", *OPERANDS[:3], "created_at", "tick_id"]
REJECTED = [*REJECTED_RULE, OPERANDS[3]]


def evaluate_cycle(
    rules: DataFrame,
    ticks: DataFrame,
    *,
    store: str | None = None,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = RULE_KEY,
    already: DataFrame | None = None,
    matched: Callable[[DataFrame], DataFrame] | None = None,
) -> Cycle:
    """Evaluate pending rules against the latest tick of their asset, once.

    Give ``store`` wherever more than one output is used. The latest ticks and then the outcome are
    written there and read back. The first lets the planner see the real size of the tick side: if
    it is below the broadcast threshold, the rules are joined where they are read, without a
    shuffle. The second makes notifications and flags agree even if the ticks change meanwhile.
    Without ``store`` every output is one lazy plan that evaluates the match for itself.

    ``already`` holds keys that fired before and are not flagged in ``rules`` yet; they are
    removed from the outcome, which is far smaller than the rules. ``matched`` takes the latest ticks and gives evaluated pairs in place
    of matching all pending rules.
    """
    latest = latest_ticks(ticks, tiebreak)
    if store is not None:
        latest = stored(latest, f"{store}/latest")
    pairs = matched(latest) if matched else evaluate_thresholds(match_rules(pending_rules(rules), latest))
    if store is None and already is None:
        return Cycle(fired_only(pairs), threshold_rejects(pairs), rules, keys)
    outcome = pairs.filter(F.col("side").isNotNull() | unusable(*[F.col(c) for c in OPERANDS]))
    if already is not None:
        outcome = without_alerted(outcome, already, keys)
    if store is not None:
        # Written by the tasks that match, without another exchange: the files may be small, but a scan reads many in one task and they go with the turn.
        # The levels and the side follow from what is stored.
        outcome = evaluate_thresholds(stored(outcome.drop("profit_target", "loss_limit", "side"), f"{store}/outcome"))
    return Cycle(fired_only(outcome), outcome.filter(F.col("side").isNull()), rules, keys, already)


# -- turns -----------------------------------------------------------------------------------


def _turns(spark: SparkSession, out: str) -> dict[int, Commit]:
    """The commit of every turn that ended, the last one if a turn was run again."""
    return {c.note: c for c in commits(spark, f"{out}/fired")}


def _held(spark: SparkSession, out: str) -> set[str]:
    return {e.name for e in entries(spark, f"{out}/fired/data")}


def fired_log(spark: SparkSession, out: str, rules: DataFrame, keys: Sequence[str] = RULE_KEY, after: int = -1, before: int | None = None) -> DataFrame:
    """Keys fired by the turns kept under ``out``, once per turn, with ``fired_at`` and the turn as
    ``batch_id``. Turns up to ``after`` are left unread, dropped ones are gone."""
    fields = [*[rules.schema[k] for k in keys], T.StructField("fired_at", T.TimestampType()), T.StructField("batch_id", T.LongType())]
    held = _held(spark, out)
    chosen = [c for turn, c in _turns(spark, out).items() if turn > after and (before is None or turn < before) and c.folder in held]
    return read_folders(spark, f"{out}/fired", T.StructType(fields), chosen)


def _fired_keys(fired: DataFrame, keys: Sequence[str], began: dt.datetime, turn: int) -> DataFrame:
    """Each fired key once, NULL keys left out since they match nothing.

    ``fired_at`` is the later of the turn's start and the rule's own time: a rule stamped by a
    clock that runs ahead, or stored while the turn began, has fired all the same.
    """
    began = F.lit(began)
    if "created_at" in fired.columns:
        began = F.greatest(began, F.col("created_at").cast("timestamp"))
    dated = fired.dropna("any", subset=list(keys)).select(F.struct(*keys).alias("_key"), began.alias("fired_at"))
    once = dated.groupBy("_key").agg(F.max("fired_at").alias("fired_at"))
    return once.select("_key.*", "fired_at", F.lit(turn).cast("long").alias("batch_id"))


LEDGER = T.StructType([T.StructField(n, T.StringType()) for n in ("rule_id", "reject_id")] + [T.StructField("turn", T.IntegerType()), T.StructField("prefix", T.StringType())])
LEDGER_TURNS = 50  # whose rejects are read one by one before they are folded into the ledger


def _prefix() -> Column:
    return F.substring("rule_id", 1, 2)


def _rejects_of(spark: SparkSession, out: str, after: int) -> DataFrame:
    """What the turns after ``after`` set aside, as rows of the ledger."""
    chosen = [f"{out}/rejects/source={c.folder}" for turn, c in _turns(spark, out).items() if turn > after]
    ids = T.StructType([*LEDGER.fields[:2], T.StructField("batch_id", T.IntegerType())])
    if not chosen:
        return no_rows(spark, LEDGER)
    rows = [spark.read.schema(ids).option("basePath", folder).parquet(folder) for folder in chosen]
    return reduce(DataFrame.unionAll, rows).select("rule_id", "reject_id", F.col("batch_id").alias("turn"), _prefix().alias("prefix"))


def fold_rejects(spark: SparkSession, out: str) -> Commit | None:
    """Fold what all turns set aside into the ledger: the last reject of each rule and tick, by prefix of the rule's digest."""
    root, turns = f"{out}/ledger", _turns(spark, out)
    log = commits(spark, root)
    folded = log.base.note if log.base else -1
    if max(turns, default=-1) <= folded:
        return None
    rows = read_commits(spark, root, LEDGER, log).unionByName(_rejects_of(spark, out, folded))
    last = latest_per_key(rows, ["rule_id"], "turn").repartition("prefix")
    return write_commit(last, root, "full", note=max(turns), partition_by=["prefix"])


def _not_yet_rejected(spark: SparkSession, out: str, rejects: DataFrame, turn: int) -> DataFrame:
    """Those of ``rejects`` that differ from the last one of their rule and tick before ``turn``. Only the touched prefixes of the ledger and the turns since its
    last fold are read."""
    named = rejects.withColumns({"rule_id": digest(rejects, REJECTED_RULE), "reject_id": digest(rejects, REJECTED)})
    touched = named.agg(F.collect_set(_prefix())).first()[0]  # 256 at most
    if not touched:
        return named
    log = commits(spark, f"{out}/ledger")
    ledger = read_commits(spark, f"{out}/ledger", LEDGER, log).unionByName(_rejects_of(spark, out, log.base.note if log.base else -1))
    held = ledger.filter(F.col("prefix").isin(touched) & (F.col("turn") < turn)).join(named.select("rule_id").distinct(), "rule_id", "left_semi")
    last = held.groupBy("rule_id").agg(F.max_by("reject_id", "turn").alias("reject_id"))
    return named.join(last, ["rule_id", "reject_id"], "left_anti")


def run_turn(
    rules: DataFrame,
    ticks: DataFrame,
    out: str,
    turn: int | None = None,
    *,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = RULE_KEY,
    folded: int = -1,
    batch_id: int | None = None,
    matched: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Run one turn, store what it did under ``out`` and return its number.

    Writes ``notifications`` and ``rejects`` in folders of this run and commits ``fired`` (keys and
    when they fired) under the turn's number, after which the turn counts and its ``work`` (latest ticks, evaluated
    rows) is removed. The rules table itself is not rewritten. Earlier turns' keys count as
    flagged; turns up to ``folded`` are in the rules table already (``fold_rules``) and are not
    read. A turn that died never counted; what it left is dropped with the others.

    Turns number themselves in the order in which they end. Of two at once, the second finds its number taken, leaves out what
    the first has fired meanwhile and takes the next: both logs count, and no rule alerts twice. ``batch_id`` names the
    micro-batch behind a turn: if a turn of that batch of that stream has ended, it is not run again. A row that cannot be evaluated is
    written to ``rejects`` once, until its rule or the tick it met changes. A given ``turn`` is run anew and replaces the one before.
    """
    began = dt.datetime.now(dt.timezone.utc)
    keys = list(keys)
    spark = rules.sparkSession
    source = source_key(getattr(batch_id, "source", ""))
    run = uuid.uuid4().hex
    cycle: Cycle | None = None
    while True:
        ended = _turns(spark, out)
        done = [t for t, c in ended.items() if source and c.source == source and c.batch == int(batch_id)]
        if done:
            delete(spark, f"{out}/work/{run}")
            return done[0]
        number = max([folded, *ended]) + 1 if turn is None else turn
        held = _held(spark, out)
        if any(folded < t < number and c.folder not in held for t, c in ended.items()):
            raise ValueError("turns were folded into the rules and dropped after these rules were read; read them again")
        log = fired_log(spark, out, rules, keys, after=folded, before=turn)
        if cycle is None:
            cycle = evaluate_cycle(rules, ticks, tiebreak=tiebreak, keys=keys, already=log, matched=matched, store=f"{out}/work/{run}")
        else:
            cycle = replace(cycle, fired=without_alerted(cycle.fired, log, keys))
        cycle.notifications.write.mode("overwrite").parquet(f"{out}/notifications/source={run}/batch_id={number}", compression=CODEC)
        rejects = _not_yet_rejected(spark, out, cycle.rejects.drop("side", "profit_target", "loss_limit"), number)
        rejects.write.mode("overwrite").parquet(f"{out}/rejects/source={run}/batch_id={number}", compression=CODEC)
        fired = _fired_keys(cycle.fired, keys, began, number)
        if write_commit(fired, f"{out}/fired", note=number, batch_id=batch_id, number=number, again=turn is not None, folder=run):
            break
        _forget(spark, out, run)
    if number in ended:
        _forget(spark, out, ended[number].folder)
    delete(spark, f"{out}/work/{run}")
    log = commits(spark, f"{out}/ledger")
    if number - (log.base.note if log.base else -1) > LEDGER_TURNS:
        fold_rejects(spark, out)
    return number


def _forget(spark: SparkSession, out: str, run: str) -> None:
    for name in ("notifications", "rejects"):
        delete(spark, f"{out}/{name}/source={run}")


def turn_notifications(spark: SparkSession, out: str, turn: int) -> DataFrame:
    """The notifications of a turn that counts."""
    return spark.read.parquet(f"{out}/notifications/source={_turns(spark, out)[turn].folder}")


def drop_turns(spark: SparkSession, out: str, upto: int) -> list[int]:
    """Delete what turns up to ``upto`` left, apart from their rejects and marks, and what runs left that died at one of these numbers; call it
    once they are folded into the rules and their notifications are delivered."""
    gone, turns = [], _turns(spark, out)
    fold_rejects(spark, out)
    for turn, commit in turns.items():
        if turn <= upto:
            delete(spark, f"{out}/fired/data/{commit.folder}")
            delete(spark, f"{out}/notifications/source={commit.folder}")
            gone.append(turn)
    counted = {c.folder for c in turns.values()}
    for entry in entries(spark, f"{out}/notifications"):
        run = entry.name.removeprefix("source=")
        numbers = [e.name.removeprefix("batch_id=") for e in entries(spark, f"{out}/notifications/{entry.name}")]
        if run not in counted and any(n.isdigit() and int(n) <= upto for n in numbers):
            _forget(spark, out, run)
            delete(spark, f"{out}/work/{run}")
    return sorted(gone)


# -- the rules table -------------------------------------------------------------------------


class Rules(NamedTuple):
    """The rules in force and the last turn folded into them."""

    rows: DataFrame
    folded: int


def read_rules(spark: SparkSession, root: str, schema: T.StructType = RULE) -> Rules:
    """The rules table: its newest full state and every batch stored since. Pass ``folded`` to ``run_turn``."""
    log = commits(spark, root)
    return Rules(read_commits(spark, root, schema, log), log.base.note if log.base else -1)


def _folded(rules: DataFrame, log: DataFrame, keys: Sequence[str], purge: bool) -> DataFrame:
    # flagged rules that go anyway are not read, let alone shuffled
    return without_alerted(purge_flagged(rules), log, keys) if purge else mark_alerted(rules, log, keys)


def compact_rules(
    rules: DataFrame,
    log: DataFrame,
    root: str,
    *,
    upto: int | None = None,
    turn: int = -1,
    keys: Sequence[str] = RULE_KEY,
    purge: bool = True,
) -> Commit:
    """Commit ``rules`` with the fired log folded in as the table's full state, without the flagged
    rules if ``purge``. Flag values get a folder each, so a pending scan never opens flagged rules.
    The join's own partitions are written as they are; rules are not shuffled again."""
    return write_commit(_folded(rules, log, keys, purge), root, "full", upto=upto, note=turn, partition_by=["is_alerted"])


def fold_rules(spark: SparkSession, root: str, out: str, schema: T.StructType = RULE, *, keys: Sequence[str] = RULE_KEY, purge: bool = True) -> Commit | None:
    """Fold the turns under ``out`` into the rules table. Rules stored meanwhile are left as they are, and a cleanup that ends meanwhile is
    what the fold then starts from; None while there is nothing to fold."""

    def change(rules: DataFrame, log: Log) -> tuple[DataFrame, int] | None:
        folded = log.base.note if log.base else -1
        turns = [t for t in _turns(spark, out) if t > folded]
        if not turns:
            return None
        fired = fired_log(spark, out, rules, keys, after=folded, before=max(turns) + 1)
        return _folded(rules, fired, keys, purge), max(turns)

    return succeed(spark, root, schema, change, ["is_alerted"])
