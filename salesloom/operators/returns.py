"""Return events: row rules, duplicates and cumulative quantity/refund caps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from salesloom import contracts as C
from salesloom.functions import dates, numbers, text
from salesloom.functions.hashing import record_hash
from salesloom.operators.skew import HOT_ROWS, annotate_keys
from salesloom.session import stored

LINE_KEY = ["source_name", "source_order_id", "source_line_number"]
EVENT_KEY = ["source_name", "return_id", "return_line_number"]
EVENT_FIELDS = EVENT_KEY + [
    "source_order_id", "source_line_number", "return_date", "return_reason", "return_status",
    "quantity_returned", "refund_amount", "refund_status",
]
#: Events whose refunds are summed at once; so many of the largest refund stay below 2**63 cents.
STRETCH = 512
#: Lines of up to so many events in a batch are judged side by side.
LONG = 32
#: Rows of a line in their order: its sale, what is booked there, an event's own booked versions, the event.
SALE, BOOKED, OWN, EVENT = range(4)
#: A limit that does not bind; groups of lines in which events are counted.
UNBOUND, LINE_GROUPS = 1 << 62, 1 << 12
#: Why an event is refused by its line, by number from 1.
CAP_REASONS = ("quantity_cap", "refund_cap", "no_sale", "cancelled")


def normalize_returns(rows: DataFrame, unicode: bool = True) -> DataFrame:
    """Typed return rows with the first broken rule in ``reason``."""
    keep = [c for c in rows.columns if c not in C.RETURN_COLUMNS]
    staged = text.with_clean_text(rows, {f"_c_{c}": c for c in C.RETURN_COLUMNS}, unicode)
    staged = staged.withColumns(
        {
            "_source": text.known_channel("_c_source_name"),
            "_status": F.upper(F.coalesce("_c_return_status", F.lit(""))),
            "_refund_status": F.upper(F.coalesce("_c_refund_status", F.lit(""))),
            "_date": dates.iso_date("_c_return_date"),
            "_refund": numbers.nonnegative_money("_c_refund_amount", C.REFUND_MAX),
            "_rline": numbers.line_number("_c_return_line_number"),
            "_oline": numbers.line_number("_c_order_line_number"),
            "_units": numbers.line_number("_c_quantity_returned"),
        }
    )
    text_of = C.RETURN_REASONS
    refund_text, processed = F.col("_c_refund_amount"), F.col("_refund_status") == "PROCESSED"
    error = F.col("_refund.error")
    too_large = F.coalesce(F.abs(refund_text.try_cast("decimal(38,2)")) > F.lit(C.REFUND_MAX).cast("decimal(38,2)"), F.lit(True))
    reason = (
        F.when(F.col("_source").isNull(), text_of["channel"])
        .when(F.col("_c_return_id").isNull() | F.col("_c_order_id").isNull() | F.col("_c_return_reason").isNull(), text_of["required"])
        .when(F.col("_date").isNull(), text_of["date"])
        .when(~F.col("_status").isin(*C.RETURN_STATUSES), text_of["return_status"])
        .when(~F.col("_refund_status").isin(*C.REFUND_STATUSES), text_of["refund_status"])
        .when(processed & refund_text.isNull(), text_of["refund_required"])
        .when(processed & (error == "INVALID_NUMBER"), text_of["refund_number"])
        .when(processed & (error == "NEGATIVE_AMOUNT"), text_of["refund_negative"])
        .when(processed & error.isNotNull() & too_large, text_of["refund_range"])
        .when(processed & error.isNotNull(), text_of["refund_precision"])
        .when(~processed & refund_text.isNotNull(), text_of["refund_early"])
        .when(F.col("_status").isin("PENDING", "REJECTED") & processed, text_of["refund_open"])
        .when(F.col("_rline").isNull(), text_of["return_line_number"])
        .when(F.col("_oline").isNull(), text_of["order_line_number"])
        .when(F.col("_units").isNull(), text_of["quantity_returned"])
    )
    typed = {
        "source_name": F.col("_source"), "return_id": F.col("_c_return_id"), "return_line_number": F.col("_rline"),
        "source_order_id": F.col("_c_order_id"), "source_line_number": F.col("_oline"), "return_date": F.col("_date"),
        "return_reason": F.col("_c_return_reason"), "return_status": F.col("_status"),
        "quantity_returned": F.col("_units"),
        "refund_amount": F.when(processed, numbers.accepted("_refund").cast("decimal(16,2)")),
        "refund_status": F.col("_refund_status"),
    }
    out = staged.select(*keep, *[v.alias(c) for c, v in typed.items()], reason.alias("reason"))
    return out.withColumn("source_record_hash", record_hash(EVENT_FIELDS))


def resolve_return_versions(normalized: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Identical events count once, conflicting ones reject every version.

    Adds ``is_duplicate``; conflicts get their reason. Rows that already failed
    a rule take no part. The rows are stored first: they feed the per-key aggregate and the join back, and a plan that repeats the rules there
    outgrows the driver. Their hash follows from the stored fields and is made again where it is used; two halves of it are compared, of
    repeated events only.
    """
    normalized = stored(normalized.drop("source_record_hash")).withColumn("source_record_hash", record_hash(EVENT_FIELDS))
    half = lambda at: F.conv(F.substring("source_record_hash", at, 16), 16, -10).cast("bigint")
    passing = F.col("reason").isNull()
    keyed = normalized.withColumns({**{f"_k_{k}": F.when(passing, F.col(k)) for k in EVENT_KEY}, "_sig_a": half(1), "_sig_b": half(17)})
    stats = {
        "_min_a": F.min("_sig_a"), "_max_a": F.max("_sig_a"), "_min_b": F.min("_sig_b"), "_max_b": F.max("_sig_b"),
        "_first": F.min("source_row_number"),
    }
    keys = [f"_k_{k}" for k in EVENT_KEY]
    joined = annotate_keys(keyed, keys, stats, ["source_row_number"], hot_rows=hot_rows, keep=stored, few_repeated=True)
    conflict = F.coalesce((F.col("_min_a") != F.col("_max_a")) | (F.col("_min_b") != F.col("_max_b")), F.lit(False))
    later = passing & ~conflict & F.coalesce(F.col("source_row_number") > F.col("_first"), F.lit(False))
    return joined.select(
        *[c for c in normalized.columns if c != "reason"],
        F.when(conflict & passing, C.RETURN_REASONS["conflict"]).otherwise(F.col("reason")).alias("reason"),
        later.alias("is_duplicate"),
    )


# ---------------------------------------------------------- cumulative caps


def prior_usage(return_facts: DataFrame) -> DataFrame:
    """Units and processed refunds already booked per sale line, rejected events left out."""
    refunded = F.when(F.col("refund_status") == "PROCESSED", F.col("refund_amount"))
    return (
        return_facts.where("return_status <> 'REJECTED'")
        .groupBy(*LINE_KEY)
        .agg(F.sum("quantity_returned").alias("prior_units"), F.sum(refunded).alias("prior_refund"))
    )


def _event_terms(events: DataFrame, return_facts: DataFrame | None) -> DataFrame:
    """Keys of the events, what each uses of its line and what it asks for: that, less what its own earlier version has booked there.

    Units, and refund in cents. A rejected event asks for no units and uses nothing.
    """
    used = F.col("return_status") != "REJECTED"
    none, nothing = F.lit(0).cast("bigint"), F.lit(-(1 << 62)).cast("bigint")
    out = events.select(
        *EVENT_KEY, *LINE_KEY[1:], used.alias("_used"), F.col("quantity_returned").cast("bigint").alias("_units"),
        F.coalesce(_cents("refund_amount"), none).alias("_refund"),
    )
    if return_facts is not None:
        booked = F.when(F.col("refund_status") == "PROCESSED", _cents("refund_amount"))
        own = return_facts.where("return_status <> 'REJECTED'").select(
            *EVENT_KEY, *LINE_KEY[1:], F.col("quantity_returned").cast("bigint").alias("_own_u"), F.coalesce(booked, none).alias("_own_c")
        )
        out = out.join(own, [*EVENT_KEY, *LINE_KEY[1:]], "left")
    else:
        out = out.withColumns({"_own_u": none, "_own_c": none})
    return out.select(
        *EVENT_KEY, *LINE_KEY[1:], F.when(F.col("_used"), F.col("_units") - F.coalesce("_own_u", none)).otherwise(nothing).alias("_ask_u"),
        F.when(F.col("_used"), F.col("_units")).otherwise(none).alias("_use_u"),
        (F.col("_refund") - F.coalesce("_own_c", none)).alias("_ask_c"), F.when(F.col("_used"), F.col("_refund")).otherwise(none).alias("_use_c"),
    )


def _cents(name: str) -> Column:
    return (F.col(name) * 100).cast("bigint")


def line_demand(terms: DataFrame) -> DataFrame:
    """Per sale line, its events, what all of them together use and the most one asks beyond what it uses."""
    return terms.groupBy(*LINE_KEY).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_use_u").alias("_sum_u"), F.sum(F.col("_use_c").cast("decimal(38,0)")).alias("_sum_c"),
        F.max(F.greatest(F.col("_ask_c") - F.col("_use_c"), F.lit(0))).alias("_more_c"),
    )


def line_limits(demand: DataFrame, sales: DataFrame, return_facts: DataFrame | None = None) -> DataFrame:
    """``demand`` with what is left to return and to refund, why a line is refused and whether its events compete.

    A line whose events fit together is settled by its sums: each of them fits wherever it stands. Only the events of a
    ``contested`` line depend on their order.
    """
    facts = sales.select(*LINE_KEY, "quantity", "net_amount", "sale_status")
    joined = demand.join(facts, LINE_KEY, "left")
    if return_facts is not None:
        joined = joined.join(prior_usage(return_facts), LINE_KEY, "left")
    else:
        joined = joined.withColumns({"prior_units": F.lit(0), "prior_refund": F.lit(0)})
    none = F.lit(0).cast("decimal(38,2)")
    units_left = F.col("quantity").cast("bigint") - F.coalesce(F.col("prior_units").cast("bigint"), F.lit(0))
    refund_left = F.col("net_amount").cast("decimal(38,2)") - F.coalesce(F.col("prior_refund").cast("decimal(38,2)"), none)
    refused = F.when(F.col("sale_status").isNull(), C.RETURN_REASONS["no_sale"]).when(
        F.col("sale_status") == "CANCELLED", C.RETURN_REASONS["cancelled"]
    )
    limited = joined.select(
        *LINE_KEY, "_n", "_sum_u", "_sum_c", "_more_c", refused.alias("_refused"), units_left.alias("_left_u"),
        (refund_left * 100).cast("bigint").alias("_left_c"),
    )
    fits = (F.col("_sum_u") <= F.col("_left_u")) & (F.col("_sum_c") + F.col("_more_c") <= F.col("_left_c"))
    return limited.select(
        *LINE_KEY, "_n", "_refused", "_left_u", "_left_c", (F.col("_refused").isNull() & ~F.coalesce(fits, F.lit(False))).alias("_contested")
    )


def first_refused(ask: list, use: list, left: list, at: int) -> int:
    """First event from ``at`` on that does not fit when all before it do; the number of events if there is none.

    ``ask``, ``use`` and ``left`` hold one entry per limit. Looks ahead in stretches that double up to STRETCH events, so a
    run costs its own length; sums of a stretch cannot overflow.
    """
    size, n = 8, len(ask[0])
    left = list(left)
    while at < n:
        to = min(at + size, n)
        over = np.zeros(to - at, bool)
        sums = []
        for a, u, most in zip(ask, use, left):
            total = np.cumsum(u[at:to])
            over |= a[at:to] > most - (total - u[at:to])
            sums.append(int(total[-1]))
        if over.any():
            return at + int(over.argmax())
        left = [most - s for most, s in zip(left, sums)]
        at, size = to, min(2 * size, STRETCH)
    return n


def first_fitting(ask: list, left: list, at: int) -> int:
    """First event from ``at`` on that fits into what is left; the number of events if none does."""
    size, n = 8, len(ask[0])
    while at < n:
        to = min(at + size, n)
        fits = np.logical_and.reduce([a[at:to] <= most for a, most in zip(ask, left)])
        if fits.any():
            return at + int(fits.argmax())
        at, size = to, 2 * size
    return n


def settle_run(ask: list, use: list, left: list) -> tuple[np.ndarray, list]:
    """Verdict of each event of one line in order (0 fits, 1 breaks the first limit, 2 the second) and what is left.

    Accepted and refused events come in runs; each run is found as a whole. Limits only fall, so an event refused once is never
    looked at again.
    """
    out = np.zeros(len(ask[0]), np.int8)
    at = 0
    while at < len(out):
        stop = first_refused(ask, use, left, at)
        left = [most - int(u[at:stop].sum(dtype=object)) for u, most in zip(use, left)]
        at = first_fitting(ask, left, stop)
        out[stop:at] = np.where(ask[0][stop:at] > left[0], 1, 2)
    return out, left


def _settle_lines(code, start, size, ask, use, left) -> None:
    """Verdicts into ``code`` for the lines whose ``size`` events stand from ``start`` on; ``left`` is brought down to what remains.

    The k-th events of all lines are judged at once; a line of many events is settled by itself, in runs.
    """
    never = np.zeros(len(code), bool)
    for s, n, most in zip(start[size > LONG], size[size > LONG], left[0][size > LONG]):
        never[s:s + n] = ask[0][s:s + n] > most  # more than the line had to begin with: not looked at again
    code[never] = 1
    for i in np.flatnonzero(size > LONG):
        at = start[i] + np.flatnonzero(~never[start[i]:start[i] + size[i]])
        code[at], rest = settle_run([a[at] for a in ask], [u[at] for u in use], [int(most[i]) for most in left])
        for most, now in zip(left, rest):
            most[i] = now
    lines = np.flatnonzero((size > 0) & (size <= LONG))
    for k in range(int(size[lines].max(initial=0))):
        lines = lines[size[lines] > k]
        at = start[lines] + k
        broken = np.where(ask[0][at] > left[0][lines], 1, np.where(ask[1][at] > left[1][lines], 2, 0))
        code[at] = broken
        for u, most in zip(use, left):
            most[lines] -= np.where(broken == 0, u[at], 0)


def _changes(columns: list) -> np.ndarray:
    """Where a row differs from the one before it, the first row included; nulls are alike."""
    n = len(columns[0])
    out = np.ones(n, bool)
    flat = lambda x: x.to_numpy(zero_copy_only=False)
    out[1:] = np.logical_or.reduce([flat(pc.not_equal(c[1:], c[:-1]).fill_null(False)) | (flat(c[1:].is_null()) != flat(c[:-1].is_null())) for c in columns])
    return out


def _one_fits(a, u, left) -> bool:
    """Whether all events of a line fit together; a null limit leaves that open."""
    more = max((int(x) for x in np.maximum(a[1] - u[1], 0)), default=0)
    return all(most < UNBOUND // 2 for most in left) and int(u[0].sum(dtype=object)) <= left[0] and int(u[1].sum(dtype=object)) + more <= left[1]


def _judge(rows: pa.RecordBatch, state: tuple | None, carried: list[str]) -> tuple[pa.RecordBatch, tuple]:
    """Events among ``rows`` with their verdict's number, and what is left of the last line; ``state`` is that of the line before.

    No event is cut off from the rows of its key. A verdict counts for all events of its key, as in a join on it: sales that stand there more than once judge each event as
    often, unless all fit together.
    """
    keys = [rows.column(c) for c in LINE_KEY]
    kind, flag, a, b = (rows.column(c).to_numpy() for c in ("_kind", "_flag", "_a", "_b"))
    new = _changes(keys)
    run = new | _changes([rows.column(c) for c in EVENT_KEY[1:]])
    start, of, run_start, run_of = np.flatnonzero(new), np.cumsum(new) - 1, np.flatnonzero(run), np.cumsum(run) - 1
    copies = np.add.reduceat(kind == SALE, start, dtype=np.int64)
    left, refused = [np.where(copies > 0, x[start], 0) for x in (a, b)], np.where(copies > 0, flag[start], CAP_REASONS.index("no_sale") + 1)
    if state and state[0] == tuple(k[0].as_py() for k in keys):
        left[0][0], left[1][0], copies[0], refused[0] = state[1:]
    left = [most - np.add.reduceat(np.where(kind == BOOKED, x, 0), start) for most, x in zip(left, (a, b))]
    own = np.add.reduceat(kind == OWN, run_start, dtype=np.int64)
    event = np.flatnonzero(kind == EVENT)

    def judged(times):  # the events, each so many times, beside its own booked versions in turn
        at = np.repeat(event, times)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        n = own[run_of[at]]
        booked = run_start[run_of[at]] + nth % np.maximum(n, 1)
        used = flag[at] == 1
        ask = [np.where(used, a[at] - np.where(n > 0, a[booked], 0), -UNBOUND), b[at] - np.where(n > 0, b[booked], 0)]
        return at, ask, [np.where(used, a[at], 0), np.where(used, b[at], 0)], np.bincount(of[at], minlength=len(start))

    times = np.maximum(own[run_of[event]], 1)
    at, ask, use, size = judged(times)
    again = np.flatnonzero((copies > 1) & (refused == 0) & (size > 0))
    if len(again):
        first, many = np.cumsum(size) - size, np.ones(len(start), np.int64)
        for i in again:
            part = slice(first[i], first[i] + size[i])
            many[i] = 1 if _one_fits([x[part] for x in ask], [x[part] for x in use], [int(most[i]) for most in left]) else copies[i]
        at, ask, use, size = judged(times * many[of[event]])
    code = np.zeros(len(at), np.int8)
    _settle_lines(code, np.cumsum(size) - size, np.where(refused == 0, size, 0), ask, use, left)
    gone = np.unique(run_of[event[refused[of[event]] > 0]])  # one verdict a key and sale
    line_of = of[run_start[gone]]
    gone, line_of = np.repeat(gone, np.maximum(copies[line_of], 1)), np.repeat(line_of, np.maximum(copies[line_of], 1))
    place = np.concatenate([run_of[at[code > 0]], gone])
    codes = np.concatenate([code[code > 0], refused[line_of]])[np.argsort(place, kind="stable")]
    verdicts = np.bincount(place, minlength=len(run_start))
    shift = np.cumsum(verdicts) - verdicts
    nameless = np.logical_or.reduce([rows.column(c).is_null().to_numpy(zero_copy_only=False) for c in EVENT_KEY[1:]])
    verdicts[run_of[nameless]] = 0  # an event without a key meets no verdict
    n = verdicts[run_of[event]]
    out = np.repeat(event, np.maximum(n, 1))
    nth = np.arange(len(out)) - np.repeat(np.cumsum(np.maximum(n, 1)) - np.maximum(n, 1), np.maximum(n, 1))
    broken = np.zeros(len(out), np.int8)
    hit = verdicts[run_of[out]] > 0
    broken[hit] = codes[(shift[run_of[out]] + nth)[hit]]
    taken, end = pa.array(out), rows.num_rows - 1
    found = pa.RecordBatch.from_arrays([*[rows.column(c).take(taken) for c in carried], pa.array(broken, pa.int8())], [*carried, "_broken"])
    return found, (tuple(k[end].as_py() for k in keys), left[0][-1], left[1][-1], copies[-1], refused[-1])


def _judge_dealt(carried: list[str]):
    """The pass over rows by line. Rows of an unfinished event key wait for the next batch; so do those of a line whose sale stands there more than once."""

    def run(batches):
        held, whole, state = [], False, None
        name = lambda batch, i: tuple(batch.column(c)[i].as_py() for c in LINE_KEY)
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if whole and name(held[0], 0) == name(batch, batch.num_rows - 1):
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lines = _changes([rows.column(c) for c in LINE_KEY])
            last = int(np.flatnonzero(lines)[-1])
            cut = int(np.flatnonzero(lines | _changes([rows.column(c) for c in EVENT_KEY[1:]]))[-1])
            whole = int((rows.column("_kind").to_numpy()[last:] == SALE).sum()) > 1
            cut = last if whole else cut
            if cut:
                out, state = _judge(rows.slice(0, cut), state, carried)
                yield out
            held = [rows.slice(cut)]
        if held:
            yield _judge(pa.Table.from_batches(held).combine_chunks().to_batches()[0], state, carried)[0]

    return run


def _dealt(events: DataFrame, sales: DataFrame, return_facts: DataFrame | None, carried: list[str]) -> DataFrame:
    """``carried`` columns of the events with the verdict's place in CAP_REASONS from 1 on in ``_broken``, 0 if they fit.

    One shuffle deals sales, booked returns and events by line. Within a line the sale comes first, then what is booked there, then the events in
    (return_id, return_line_number) order, each after its own booked versions. What passes from event to event is two numbers: an accepted one uses up units and
    refund, a refused one does not, so each verdict needs those before it. A null limit does not bind.
    """
    kinds = events.schema
    zero, tiny = F.lit(0).cast("bigint"), lambda c: c.cast("tinyint")
    spare = [c for c in carried if c not in LINE_KEY + EVENT_KEY]
    none = [F.lit(None).cast(kinds[c].dataType).alias(c) for c in spare]
    apart = [F.lit(None).cast(kinds[c].dataType).alias(c) for c in EVENT_KEY[1:]]
    line = [F.col(c).cast(kinds[c].dataType).alias(c) for c in LINE_KEY]

    def row(kind, flag, units, cents):
        return [tiny(F.lit(kind)).alias("_kind"), tiny(flag).alias("_flag"), units.cast("bigint").alias("_a"), cents.cast("bigint").alias("_b")]

    known = " AND ".join(f"{k} IS NOT NULL" for k in LINE_KEY)
    bound = lambda c: F.coalesce(c.cast("bigint"), F.lit(UNBOUND))
    number = {name: i + 1 for i, name in enumerate(CAP_REASONS)}
    refused = F.when(F.col("sale_status").isNull(), number["no_sale"]).when(F.col("sale_status") == "CANCELLED", number["cancelled"]).otherwise(0)
    used = F.coalesce(F.col("return_status") != "REJECTED", F.lit(False))
    amounts = [F.coalesce(F.col("quantity_returned").cast("bigint"), zero), F.coalesce(_cents("refund_amount"), zero)]
    both = events.where(known).select(*line, *EVENT_KEY[1:], *row(EVENT, used.cast("int"), *amounts), *spare)
    limits = row(SALE, refused, bound(F.col("quantity")), bound(F.col("net_amount").cast("decimal(38,2)") * 100))
    both = both.unionByName(sales.where(known).select(*line, *apart, *limits, *none))
    if return_facts is not None:
        booked = return_facts.where("return_status <> 'REJECTED'").where(known)
        processed = F.coalesce(F.when(F.col("refund_status") == "PROCESSED", _cents("refund_amount")), zero)
        facts = booked.select(*line, *[F.col(c).cast(kinds[c].dataType).alias(c) for c in EVENT_KEY[1:]], F.explode(F.array(F.lit(BOOKED), F.lit(OWN))).alias("_kind"), amounts[0].alias("_a"), processed.alias("_b"))
        facts = facts.where(f"_kind = {BOOKED} OR " + " AND ".join(f"{c} IS NOT NULL" for c in EVENT_KEY[1:]))
        keys = [F.when(F.col("_kind") == OWN, F.col(c)).alias(c) for c in EVENT_KEY[1:]]
        both = both.unionByName(facts.select(*LINE_KEY, *keys, tiny(F.col("_kind")).alias("_kind"), tiny(F.lit(0)).alias("_flag"), "_a", "_b", *none))
    ordered = both.repartition(*LINE_KEY).sortWithinPartitions(*reversed(LINE_KEY[:2]), LINE_KEY[2], *EVENT_KEY[1:], "_kind")
    spec = ", ".join(f"`{c}` {kinds[c].dataType.simpleString()}" for c in carried)
    return ordered.mapInArrow(_judge_dealt(carried), f"{spec}, _broken tinyint")


def _hot_lines(events: DataFrame, sales: DataFrame, return_facts: DataFrame | None, hot_rows: int) -> DataFrame | None:
    """Lines of more than ``hot_rows`` events that their sums settle, with why they are refused; None if there are none.

    Events are first counted by a few hashed groups of lines, and the demand added up in groups of more than ``hot_rows`` events only.
    """
    group = F.pmod(F.xxhash64(*LINE_KEY), F.lit(LINE_GROUPS))
    full = [r["g"] for r in events.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).collect()]  # at most LINE_GROUPS
    if not full:
        return None
    demand = line_demand(_event_terms(events.where(group.isin(full)), return_facts)).where(F.col("_n") > hot_rows)
    return stored(line_limits(demand, sales, return_facts).where(~F.col("_contested")).select(*LINE_KEY, "_refused"))


def _capped(events: DataFrame, sales: DataFrame, return_facts: DataFrame | None, hot_rows: int, columns: list[str]) -> DataFrame:
    """``columns`` of the events whose line is known, with ``cap_reason``."""
    hot = _hot_lines(events, sales, return_facts, hot_rows)
    dealt = events if hot is None else events.join(F.broadcast(hot), LINE_KEY, "left_anti")
    broken = F.coalesce(*[F.when(F.col("_broken") == i + 1, C.RETURN_REASONS[n]) for i, n in enumerate(CAP_REASONS)])
    out = _dealt(dealt, sales, return_facts, columns).select(*columns, broken.alias("cap_reason"))
    if hot is not None:
        apart = events.join(F.broadcast(hot), LINE_KEY, "left_semi").join(F.broadcast(hot.where("_refused IS NOT NULL")), LINE_KEY, "left")
        out = out.unionByName(apart.select(*columns, F.col("_refused").alias("cap_reason")))
    return out


def apply_caps(events: DataFrame, sales: DataFrame, return_facts: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Verdict of every unique event in ``cap_reason``.

    Events are dealt by line once, with all their columns, beside the line's sale and booked returns. Lines of more than ``hot_rows`` events that their sums
    settle, of which there are few, are matched by broadcast. Events without a line have room.
    """
    unknown = events.where(" OR ".join(f"{k} IS NULL" for k in LINE_KEY)).withColumn("cap_reason", F.lit(None).cast("string"))
    return _capped(events, sales, return_facts, hot_rows, events.columns).unionByName(unknown)


def judge_returns(
    rows: DataFrame, sales: DataFrame, return_facts: DataFrame | None = None, unicode: bool = True,
    hot_rows: int = HOT_ROWS, columns: list[str] | None = None,
) -> DataFrame:
    """Whole return job: rules, versions, sale reference and caps.

    Every input row comes back with ``disposition`` accepted, duplicate or
    rejected, and its ``reason``. ``columns`` names what else is wanted of the rows, all
    by default; the others are not dealt. The hash follows from the fields and is made again.
    """
    resolved = resolve_return_versions(normalize_returns(rows, unicode), hot_rows)
    wanted = [c for c in resolved.columns if c not in ("reason", "is_duplicate") and (columns is None or c in columns)]
    candidates = resolved.where("reason IS NULL AND NOT is_duplicate")
    hashed = "source_record_hash" in wanted
    carried = [c for c in candidates.columns if c not in ("reason", "is_duplicate", "source_record_hash") and (c in wanted or hashed and c in EVENT_FIELDS)]
    judged = _capped(candidates.drop("source_record_hash"), sales, return_facts, HOT_ROWS, carried)
    settled = judged.withColumns({"source_record_hash": record_hash(EVENT_FIELDS)} if hashed else {}).select(
        *wanted, F.col("cap_reason").alias("reason"),
        F.when(F.col("cap_reason").isNull(), "accepted").otherwise("rejected").alias("disposition"),
    )
    others = resolved.where("reason IS NOT NULL OR is_duplicate").select(
        *wanted, "reason",
        F.when(F.col("reason").isNotNull(), "rejected").otherwise("duplicate").alias("disposition"),
    )
    return settled.unionByName(others)


def rejection_reasons(judged: DataFrame) -> DataFrame:
    """Rejected events by reason."""
    return judged.where("disposition = 'rejected'").groupBy("reason").agg(F.count(F.lit(1)).alias("events"))
