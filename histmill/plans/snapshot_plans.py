"""Transaction-log queries: sticky headers, as-of labels, promotion set."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from histmill.operators import snapshots as sn
from histmill.plans.registry import query
from histmill.session import ensure_checkpoint_dir
from histmill.sources.files import read_transactions
from histmill.sources.tables import read_table

# snapshot labels: (name, local time text); the first lies before every check-in
LABELS = [("SP0", "2023-12-31T12:00:00"), ("SP1", "2024-01-03T09:26:00"), ("SP2", "2024-01-09T11:05:00"),
          ("SP3", "2024-01-15T13:26:00"), ("SP4", "2024-01-22T03:21:00"), ("SP5", "2024-01-29T09:07:00")]
GA_TIME = "2024-01-12 09:26:00"
MARKER_EVENT = "signup"

LABELS_SQL = "labels(seq, label, label_time) as (values " + ", ".join(
    f"({i + 1}, '{n}', timestamp '{t.replace('T', ' ')}')" for i, (n, t) in enumerate(LABELS)) + ")"

CHECKINS_SQL = """ck as (
  select event_id // 10 as tran_num, date_trunc('second', ts) as checkin_time, event_id as line_no from events)"""

INITIAL_SQL = f"""init as (
  select arg_max(event_id // 10, event_id) as initial_tran from events where event_type = '{MARKER_EVENT}')"""


def log_lines(spark, sf):
    """The history listing as numbered text lines, rebuilt from the check-in events:
    a header per transaction, one check-in line per event, a marker line on
    initial-import events."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])
    tran = F.expr("event_id div 10")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    header = ev.where(F.col("event_id") % 10 == 0).select(
        (F.col("event_id") * 3).alias("line_no"),
        F.concat(F.lit("transaction "), tran.cast("string"), F.lit("; promote; "), stamp, F.lit(" ; user: user"),
                 F.col("user_id").cast("string")).alias("value"))
    checkin = ev.select((F.col("event_id") * 3 + 1).alias("line_no"),
                        F.concat(F.lit("  # SS "), F.col("event_type"), F.lit(" Time: "), stamp).alias("value"))
    marker = ev.where(F.col("event_type") == MARKER_EVENT).select(
        (F.col("event_id") * 3 + 2).alias("line_no"), F.lit("  # Import initial source tree").alias("value"))
    return header.unionByName(checkin).unionByName(marker).withColumn("file", F.lit("main"))


LOG_SQL = f"""lines as (
  select 'main' as file, event_id * 3 as line_no,
    'transaction ' || cast(event_id // 10 as varchar) || '; promote; ' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
    || ' ; user: user' || cast(user_id as varchar) as value, event_id // 10 as hdr
  from events where event_id % 10 = 0
  union all
  select 'main', event_id * 3 + 1, '  # SS ' || event_type || ' Time: ' || strftime(ts, '%Y-%m-%dT%H:%M:%S'), null
  from events
  union all
  select 'main', event_id * 3 + 2, '  # Import initial source tree', null from events where event_type = '{MARKER_EVENT}')"""


@query("log_forward_fill", oracle=f"""with {LOG_SQL}
select file, line_no,
  last_value(hdr ignore nulls) over (partition by file order by line_no rows between unbounded preceding and current row)
    as tran_num,
  case when regexp_matches(value, '^  # SS [^\\n]+Time: (\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}})')
    then strptime(regexp_extract(value, 'Time: (\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}})', 1), '%Y-%m-%dT%H:%M:%S')
  end as checkin_time,
  regexp_matches(value, '^  # Import initial source') as is_initial
from lines""")
def log_forward_fill(spark, sf):
    """SRC4 + WIN5 + FLT8 + SC20: parse the listing; the header's transaction number is sticky."""
    return sn.parse_tran_log(log_lines(spark, sf), "file", "line_no", "value")


@query("log_records", oracle=f"""with {LOG_SQL}
select line_no // 30 as tran_num, cast(row_number() over (partition by line_no // 30 order by line_no) - 1 as integer) as pos,
  case when regexp_matches(value, '^  # SS [^\\n]+Time: ')
    then strptime(regexp_extract(value, 'Time: (\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}})', 1), '%Y-%m-%dT%H:%M:%S')
  end as checkin_time,
  regexp_matches(value, '^  # Import initial source') as is_initial
from lines""")
def log_records(spark, sf):
    """SRC4: the listing written as text files (a transaction stays in one) and read back by
    transaction records, without ordering its lines again."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/listing-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (log_lines(spark, sf).withColumn("tran", F.expr("line_no div 30")).repartitionByRange(n, "tran")
     .sortWithinPartitions("line_no").select("value").write.text(path))
    return sn.parse_transactions(read_transactions(spark, path)).select("tran_num", "pos", "checkin_time", "is_initial")


def checkins(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    return ev.select(F.expr("event_id div 10").alias("tran_num"), F.date_trunc("second", "ts").alias("checkin_time"),
                     F.col("event_id").alias("line_no"))


@query("asof_label", oracle=f"""with {LABELS_SQL}, {CHECKINS_SQL},
m as (
  select l.seq, arg_max(c.tran_num, (c.checkin_time, c.tran_num)) as tran_num, max(c.checkin_time) as matched_time
  from labels l join ck c on c.checkin_time <= l.label_time group by l.seq),
f as (select tran_num, arg_min(checkin_time, line_no) as first_time from ck group by tran_num)
select l.seq, l.label, l.label_time, m.tran_num, m.matched_time, f.first_time
from labels l left join m on m.seq = l.seq left join f on f.tran_num = m.tran_num""")
def asof_label(spark, sf):
    """JN13 + AGG11 + SRC6: snapshot labels resolved to the latest transaction at or before them."""
    labels = sn.labels_frame(spark, LABELS)
    return sn.asof_labels(labels, checkins(spark, sf)).select(
        "seq", "label", "label_time", "tran_num", "matched_time", "first_time")


@query("asof_label_sorted", oracle=f"""with {LABELS_SQL}, {CHECKINS_SQL},
m as (
  select l.seq, arg_max(c.tran_num, (c.checkin_time, c.tran_num)) as tran_num
  from labels l join ck c on c.checkin_time <= l.label_time group by l.seq)
select l.seq, l.label, l.label_time, m.tran_num from labels l left join m on m.seq = l.seq""")
def asof_label_sorted(spark, sf):
    """JN13 for unbounded label sets: union + distributed forward fill in time order."""
    labels = sn.labels_frame(spark, LABELS)
    return sn.asof_labels_sorted(labels, checkins(spark, sf)).select("seq", "label", "label_time", "tran_num")


def initial(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "event_type"])
    marks = ev.where(F.col("event_type") == MARKER_EVENT).select(
        F.lit("main").alias("file"), F.expr("event_id div 10").alias("tran_num"), F.col("event_id").alias("line_no"),
        F.lit(True).alias("is_initial"))
    return sn.initial_transaction(marks, "file", "line_no")


@query("ga_promote_set", oracle=f"""with {CHECKINS_SQL}, {INITIAL_SQL}
select initial_tran as tran_num from init
union all
select tran_num from ck group by tran_num having max(checkin_time) <= timestamp '{GA_TIME}'""")
def ga_promote_set(spark, sf):
    """CMP9 + AGG10 + DQ3: transactions complete by the GA time, plus the initial one."""
    return sn.promote_set(checkins(spark, sf), initial(spark, sf), GA_TIME)


@query("xml_tran_list", oracle=f"""with {CHECKINS_SQL}, {INITIAL_SQL},
ga as (
  select initial_tran as tran_num from init
  union all
  select tran_num from ck group by tran_num having max(checkin_time) <= timestamp '{GA_TIME}')
select 0 as seq, cast(null as varchar) as key, '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<transactions>' as line
union all select 2, null, '</transactions>'
union all select 1, cast(tran_num as varchar), '<id>' || cast(tran_num as varchar) || '</id>' from ga""")
def xml_tran_list(spark, sf):
    """SNK5 + SRT2: the promotion list document as ordered lines (ids sorted as text)."""
    lines = sn.xml_tran_lines(ga_promote_set(spark, sf))
    return lines.orderBy("seq", "key")
