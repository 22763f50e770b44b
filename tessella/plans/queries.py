"""Registered queries over the driver tables, each with the DuckDB SQL it must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.operators import allocate, analytics, browse, frames, intake, keys, letters, privacy, release, sampling, tree
from tessella.sources import readers, shared
from tessella.streaming import intake_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ASSISTANTS = ["RA1", "RA2", "RA3", "RA4"]
SEED = 20260701


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def put(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return put


def long(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


SQL_SPACES = r"[\p{Z}\t-\r\x{85}]+"
SQL_NORMAL = "trim(regexp_replace(coalesce(text, ''), '" + SQL_SPACES + "', ' ', 'g'))"
LETTER = "To {office_name} ({segment}), in {nation}: {balance}. {treatment_paragraph}Yours, {filer_name}"
PARAGRAPH = "The law sets 30 days for {office_name}. "


# --- text and keys -------------------------------------------------------------------------------------------------------------------------------


@query(f"select doc_id, md5({SQL_NORMAL}) as text_md5, md5(lower({SQL_NORMAL})) as key_md5, length({SQL_NORMAL}) as n from documents")
def normalize_doc_keys(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    n = tx.normalize_text("text")
    return d.select("doc_id", F.md5(n.cast("binary")).alias("text_md5"), F.md5(tx.normalize_key("text").cast("binary")).alias("key_md5"), long(F.char_length(n)).alias("n"))


@query("select doc_id, substr(sha256(coalesce(text, '')), 1, 16) as h16, substr(sha256(coalesce(source, '')), 1, 12) as h12 from documents")
def text_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.hash_text("text").alias("h16"), tx.hash_text("source", 12).alias("h12"))


@query(
    "with k as (select p_partkey, lower(trim(p_name)) || '|' || lower(p_brand) as key, row_number() over (partition by lower(trim(p_name)) || '|' || lower(p_brand) order by p_partkey) as occurrence from part) "
    "select p_partkey, occurrence, substr(sha256(case when occurrence > 1 then key || '|occurrence:' || occurrence else key end), 1, 12) as authority_id from k"
)
def authority_ids(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("key", tx.authority_key("p_name", "p_brand"))
    n = keys.occurrence(["key"], ["p_partkey"])
    return p.withColumn("occurrence", long(n)).select("p_partkey", "occurrence", tx.authority_id(F.col("key"), F.col("occurrence")).alias("authority_id"))


@query(
    "with u as (select url as v from pages union all select p_name from part) select regexp_replace(lower(coalesce(v, '')), '[^a-z0-9]', '', 'g') as match_key, count(*) as n, count(distinct v) as spellings from u group by 1"
)
def match_key_collapse(spark, sf_dir):
    u = table(spark, sf_dir, "pages").select(F.col("url").alias("v")).union(table(spark, sf_dir, "part").select("p_name"))
    return u.groupBy(tx.match_key("v").alias("match_key")).agg(F.count("*").alias("n"), F.countDistinct("v").alias("spellings"))


def _office_names(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        F.concat("p_type", F.lit(" & "), "p_brand", F.lit(" Department (Unit "), F.col("p_size").cast("string"), F.lit("), South")).alias("head_name"),
        F.concat(F.lit("Office "), F.col("p_size").cast("string"), F.lit(" - North, Department of "), "p_type", F.lit(" & "), "p_brand").alias("tail_name"),
    )


@query(
    "with o as (select p_partkey, p_type || ' & ' || p_brand || ' Department' as h, p_type || ' & ' || p_brand as t from part) "
    "select p_partkey, regexp_replace(regexp_replace(upper(trim(h)), ' *& *', ' AND ', 'g'), ' DEPARTMENT$', '') as head_group, regexp_replace(upper(trim(t)), ' *& *', ' AND ', 'g') as tail_group from o"
)
def department_group_parse(spark, sf_dir):
    return _office_names(spark, sf_dir).select("p_partkey", tx.department_group("head_name", "TN").alias("head_group"), tx.department_group("tail_name", "KA").alias("tail_group"))


@query(
    "with s as (select s_suppkey, '  \"Office \"' || s_name || 'x\"s  Hall\"' as v, case s_suppkey % 6 when 0 then ' na ' when 1 then 'N/A' when 2 then '-' when 3 then 'none' else s_name end as l from supplier) "
    "select s_suppkey, regexp_replace('Office \"' || ltrim(substr(v, 12)), '^Office \"(.*)\"s +Hall\"$', 'Office \"\\1''s Hall') as office, case when upper(trim(l)) in ('NA', 'N/A', 'NIL', 'NONE', '-') then '' else trim(l) end as place from s"
)
def clean_office_names(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    office = F.concat(F.lit('  "Office "'), "s_name", F.lit('x"s  Hall"'))
    k = F.col("s_suppkey") % 6
    place = F.when(k == 0, " na ").when(k == 1, "N/A").when(k == 2, "-").when(k == 3, "none").otherwise(F.col("s_name"))
    return s.select("s_suppkey", tx.clean_office_text(office).alias("office"), tx.clean_location(place).alias("place"))


@query(
    "select p_name as value, count(*) as rows, 'duplicate' as reason from part where coalesce(p_name, '') != '' group by 1 having count(*) > 1 union all select '', count(*), 'blank' from part where coalesce(p_name, '') = '' having count(*) > 0"
)
def dup_key_violations(spark, sf_dir):
    return keys.key_violations(table(spark, sf_dir, "part"), "p_name")


@query(
    "with old as (select c_nationkey as k, c_name as last_name, c_acctbal as last_balance, row_number() over (partition by c_nationkey order by c_custkey desc) as n from customer) "
    "select s_suppkey, s_nationkey, last_name, last_balance from supplier left join (select * from old where n = 1) on k = s_nationkey"
)
def legacy_lookup_keep_last(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("s_nationkey"), F.col("c_name").alias("last_name"), F.col("c_acctbal").alias("last_balance"), F.col("c_custkey").alias("pos"))
    return keys.lookup_keep_last(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), old, ["s_nationkey"], "pos").select("s_suppkey", "s_nationkey", "last_name", "last_balance")


@query(
    "with a as (select p_partkey, p_name, row_number() over (partition by p_name order by p_partkey) as occurrence from part), b as (select p_partkey as other_key, p_name, row_number() over (partition by p_name order by p_partkey desc) as occurrence from part) "
    "select p_partkey, other_key, a.occurrence from a join b using (p_name, occurrence)"
)
def occurrence_join_1to1(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    right = p.select("p_name", F.col("p_partkey").alias("other_key"), (-F.col("p_partkey")).alias("back"))
    return keys.one_to_one(p.select("p_name", "p_partkey"), right, "p_name", "p_partkey", "back").select("p_partkey", "other_key", long("occurrence").alias("occurrence"))


@query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def fk_orphans(spark, sf_dir):
    return keys.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


@query("select c_custkey, c_mktsegment from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def anti_issued(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_mktsegment")


@query("select n_nationkey, n_name from nation where n_nationkey in (select s_nationkey from supplier)")
def semi_batches(spark, sf_dir):
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"), "left_semi").select("n_nationkey", "n_name")


@query(
    "with i as (select 'N' || c_nationkey as code, c_custkey as k from customer) select 'N' || n_nationkey as code, coalesce(max(k), 0) + 1 as next_number, printf('%s-%03d', 'N' || n_nationkey, coalesce(max(k), 0) + 1) as next_id "
    "from nation left join i on code = 'N' || n_nationkey group by n_nationkey"
)
def next_sequence_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    issued = c.select(tx.application_id(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), F.col("c_custkey")).alias("application_id"))
    codes = table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"))
    return keys.next_sequence(issued, codes).withColumn("next_id", tx.application_id(F.col("code"), F.col("next_number")))


# --- apportionment, sampling, randomisation ------------------------------------------------------------------------------------------------------

ONCE = (
    "g as (select {g} as g, count(*) as w from {t} group by 1), q as (select *, w / sum(w) over ()::double * {n} as quota from g), "
    "f as (select *, floor(quota) as fl from q), r as (select *, {n} - sum(fl) over () as rest, row_number() over (order by quota - fl desc, g) as k from f), a as (select g, w, (fl + case when k <= rest then 1 else 0 end)::bigint as allocated from r)"
)
CAPPED = (
    "with recursive g as (select p_brand as g, count(*)::double as w, least(count(*), {cap})::bigint as cap, least(count(*), {cap}, {floor})::bigint as lo from part group by 1), "
    "s as (select 0 as step, g, w, cap, lo as a from g union all select step + 1, g, w, cap, a2 + case when live and a2 < cap and place <= rest then 1 else 0 end from ("
    "select *, {n} - sum(a2) over () as rest, row_number() over (partition by live and a2 < cap order by quota - floor(quota) desc, g) as place from ("
    "select *, a + case when live then least(floor(quota), cap - a) else 0 end::bigint as a2 from (select *, case when live then w / sum(case when live then w end) over () * ({n} - sum(a) over ()) end as quota from ("
    "select *, a < cap and w > 0 as live, sum(a) over () as given from s where step < 40))) where given < {n})) "
    "select g as p_brand, w::bigint as weight, cap, a::bigint as allocated from s where step = (select max(step) from s)"
)


@query("with " + ONCE.format(g="p_brand", t="part", n=150) + " select g as p_brand, w as weight, allocated from a")
def alloc_uncapped(spark, sf_dir):
    g = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("weight"))
    return allocate.apportion_once(g, 150, "p_brand", "weight")


def _brands(spark, sf_dir, cap: int, floor: int) -> DataFrame:
    g = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("weight"))
    return g.withColumn("cap", F.least("weight", F.lit(cap)).cast("long")).withColumn("lo", F.least("cap", F.lit(floor)).cast("long"))


def _capped(spark, sf_dir, cap: int, floor: int, total: int) -> DataFrame:
    g = _brands(spark, sf_dir, cap, floor)
    reach = g.agg(F.sum("cap")).first()[0]
    return allocate.apportion_table(g, min(total, reach), "p_brand", "weight", "cap", "lo").drop("lo")


@query(CAPPED.format(cap=80, floor=0, n="(select least(1880, sum(least(n, 80))) from (select count(*) as n from part group by p_brand))"))
def alloc_capped(spark, sf_dir):
    return _capped(spark, sf_dir, 80, 0, 1880)


@query(CAPPED.format(cap=90, floor=40, n="(select least(1200, sum(least(n, 90))) from (select count(*) as n from part group by p_brand))"))
def alloc_floor(spark, sf_dir):
    return _capped(spark, sf_dir, 90, 40, 1200)


def _hash_sql(stage: str, key: str) -> str:
    return f"sha256('{SEED}|{stage}|' || {key})"


@query(
    f"select c_custkey, c_mktsegment from (select *, row_number() over (partition by c_mktsegment order by {_hash_sql('select', 'c_custkey')}, c_custkey) as k from customer) where k <= 20"
)
def srs_per_group(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    quotas = c.select("c_mktsegment").distinct().withColumn("allocated", F.lit(20))
    return sampling.sample_per_group(c, quotas, "c_mktsegment", SEED, "c_custkey").select("c_custkey", "c_mktsegment")


DRAW = (
    "with " + ONCE.format(g="c_mktsegment", t="customer", n=100) + ", picked as (select c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal from (select *, row_number() over (partition by c_mktsegment order by "
    + _hash_sql("select", "c_custkey") + ", c_custkey) as k from customer) join a on g = c_mktsegment where k <= allocated), "
    "s2 as (select c_mktsegment as g2, count(*) as w2 from picked group by 1), q2 as (select *, w2 / sum(w2) over ()::double * 30 as quota2 from s2), r2 as (select *, 30 - sum(floor(quota2)) over () as rest2, row_number() over (order by quota2 - floor(quota2) desc, g2) as k2 from q2), "
    "a2 as (select g2, floor(quota2) + case when k2 <= rest2 then 1 else 0 end as n2 from r2), treated as (select picked.*, case when row_number() over (partition by c_mktsegment order by " + _hash_sql("treat", "c_custkey")
    + ", c_custkey) <= n2 then 'legal_salience' else 'plain' end as treatment from picked join a2 on g2 = c_mktsegment), "
    "assigned as (select *, 'RA' || ((row_number() over (order by treatment, c_mktsegment, " + _hash_sql("assist", "c_custkey") + ", c_custkey) - 1) % 4 + 1) as assigned_ra from treated) "
)


def _drawn(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    sizes = c.groupBy("c_mktsegment").agg(F.count("*").alias("w"))
    # The batch's hundred rows are written once, not drawn again by each step.
    picked = shared.written(sampling.sample_per_group(c, allocate.apportion_once(sizes, 100, "c_mktsegment", "w"), "c_mktsegment", SEED, "c_custkey"), "drawn")
    treated = sampling.assign_treatments(picked, 30, ["c_mktsegment"], SEED, "c_custkey")
    return sampling.assign_assistants(treated, ASSISTANTS, SEED, "c_custkey")


@query(DRAW + "select printf('C-%03d', row_number() over (order by c_mktsegment, c_name, c_custkey)) as application_id, c_custkey, c_mktsegment, treatment, assigned_ra from assigned")
def stratified_draw(spark, sf_dir):
    order = Window.partitionBy(F.lit(1)).orderBy("c_mktsegment", "c_name", "c_custkey")  # the batch's hundred rows
    return _drawn(spark, sf_dir).select(tx.application_id(F.lit("C"), F.row_number().over(order)).alias("application_id"), "c_custkey", "c_mktsegment", "treatment", "assigned_ra")


@query("with " + ONCE.format(g="c_mktsegment", t="customer", n=120) + f" select c_custkey, c_mktsegment from (select *, row_number() over (partition by c_mktsegment order by {_hash_sql('select', 'c_custkey')}, c_custkey) as k from customer) join a on g = c_mktsegment where k <= allocated")
def proportional_sample(spark, sf_dir):
    return sampling.select_offices(table(spark, sf_dir, "customer"), sampling.Design(120, group="c_mktsegment"), SEED, "c_custkey").select("c_custkey", "c_mktsegment")


@query(
    f"with d as (select p_partkey, p_brand, case when row_number() over (partition by p_brand order by p_partkey) = 1 then 'Department' when p_size % 2 = 0 then 'Head of Department' else 'Sub Office' end as tier from part), "
    f"c as (select *, row_number() over (partition by p_brand, tier order by {_hash_sql('select', 'p_partkey')}, p_partkey) as k from d), s as (select p_partkey, p_brand, tier from c where k <= case when tier = 'Sub Office' then 2 else 1 end), "
    f"r as (select p_partkey, p_brand, tier from d where tier = 'Sub Office' and p_partkey not in (select p_partkey from s) order by {_hash_sql('refill', 'p_partkey')}, p_partkey limit 20) select * from s union all select * from r"
)
def tier_quota_sample(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("k", keys.occurrence(["p_brand"], ["p_partkey"]))
    tier = F.when(F.col("k") == 1, "Department").when(F.col("p_size") % 2 == 0, "Head of Department").otherwise("Sub Office")
    d = p.select("p_partkey", "p_brand", tier.alias("tier"))
    quotas = {"Department": 1, "Head of Department": 1, "Sub Office": 2}
    base = d.groupBy("p_brand", "tier").agg(F.count("*").alias("n")).join(spark.createDataFrame(list(quotas.items()), "tier string, q int"), "tier").agg(F.sum(F.least("n", "q"))).first()[0]
    design = sampling.Design(base + 20, "department_tier_quotas", "p_brand", tier_quotas=quotas)
    return sampling.select_offices(d, design, SEED, "p_partkey")


@query(DRAW + "select c_mktsegment as randomization_stratum, treatment, count(*) as n from assigned group by 1, 2")
def blocked_treatment(spark, sf_dir):
    return _drawn(spark, sf_dir).groupBy("randomization_stratum", "treatment").agg(F.count("*").alias("n"))


@query(DRAW + "select assigned_ra, treatment, count(*) as n, min(c_custkey) as first_key from assigned group by 1, 2")
def round_robin_assign(spark, sf_dir):
    return _drawn(spark, sf_dir).groupBy("assigned_ra", "treatment").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_key"))


@query(DRAW + "select c_mktsegment as tier, treatment, assigned_ra, (grouping(c_mktsegment) * 4 + grouping(treatment) * 2 + grouping(assigned_ra))::bigint as level, count(*) as n from assigned group by grouping sets ((c_mktsegment), (treatment), (assigned_ra), (assigned_ra, treatment), ())")
def batch_margins(spark, sf_dir):
    return sampling.batch_margins(_drawn(spark, sf_dir), "c_mktsegment")


BATCH_SQL = (
    "with issued as (select c_custkey as k, c_nationkey as s from customer where c_acctbal < 0), free as (select c_custkey, c_name, c_nationkey, c_mktsegment, 'O-' || c_custkey as authority_id from customer where c_nationkey < 10 and c_acctbal >= 0), "
    + ONCE.format(g="c_mktsegment", t="free", n=40) + ", picked as (select c_custkey, c_name, c_nationkey, c_mktsegment, authority_id from (select *, row_number() over (partition by c_mktsegment order by " + _hash_sql("select", "authority_id")
    + ", authority_id) as k from free) join a on g = c_mktsegment where k <= allocated), s2 as (select c_mktsegment as g2, count(*) as w2 from picked group by 1), q2 as (select *, w2 / sum(w2) over ()::double * 12 as quota2 from s2), "
    "r2 as (select *, 12 - sum(floor(quota2)) over () as rest2, row_number() over (order by quota2 - floor(quota2) desc, g2) as k2 from q2), a2 as (select g2, floor(quota2) + case when k2 <= rest2 then 1 else 0 end as n2 from r2), "
    "treated as (select picked.*, case when row_number() over (partition by c_mktsegment order by " + _hash_sql("treat", "authority_id") + ", authority_id) <= n2 then 'legal_salience' else 'plain' end as treatment from picked join a2 on g2 = c_mktsegment), "
    "assigned as (select *, 'RA' || ((row_number() over (order by treatment, c_mktsegment, " + _hash_sql("assist", "authority_id") + ", authority_id) - 1) % 4 + 1) as assigned_ra from treated), m as (select s, max(k) as last from issued group by 1) "
    "select printf('N%d-%03d', c_nationkey, coalesce(last, 0) + row_number() over (partition by c_nationkey order by c_mktsegment, c_name, authority_id)) as application_id, authority_id, c_mktsegment as dept_group, treatment, assigned_ra, 'b1' as batch_id, 'en' as language "
    "from assigned left join m on s = c_nationkey"
)


@query(BATCH_SQL)
def draw_batch(spark, sf_dir):
    """A batch of ten states' offices that are not issued: drawn, treated, assigned, numbered after the issued ones, stamped."""
    c = table(spark, sf_dir, "customer")
    state, office = (F.concat(F.lit(p), F.col(k).cast("string")) for p, k in (("N", "c_nationkey"), ("O-", "c_custkey")))
    frame = c.select(office.alias("authority_id"), state.alias("state_code"), F.col("c_mktsegment").alias("dept_group"), F.col("c_name").alias("office_name"), "c_acctbal", "c_custkey")
    issued = frame.filter("c_acctbal < 0").select(tx.application_id(F.col("state_code"), F.col("c_custkey")).alias("application_id"), "authority_id")
    stamp = {"template_version": "v1", "language": "en", "channel": "post"}
    rows, _ = sampling.draw_batch(frame.drop("c_acctbal", "c_custkey"), issued, sampling.Design(40), SEED, "b1", 12, ["dept_group"], ASSISTANTS, stamp, [f"N{k}" for k in range(10)])
    return rows.select("application_id", "authority_id", "dept_group", "treatment", "assigned_ra", "batch_id", "language")


@query("with b as (select distinct p_brand from part), t as (select distinct p_type from part union select 'UNSEEN') select p_brand, p_type, count(p_partkey) as n from b cross join t left join part using (p_brand, p_type) group by 1, 2")
def contingency_with_zeros(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    levels = lambda c: sorted(r[0] for r in p.select(c).distinct().collect())  # declared levels: a design's few brands and types
    return sampling.contingency(p, "p_brand", levels("p_brand"), "p_type", [*levels("p_type"), "UNSEEN"])


# --- intake --------------------------------------------------------------------------------------------------------------------------------------

LABELS = {"Opened the page": "view", "Bought it!": "purchase"}


def _form_rows(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    said = F.concat(F.lit("  "), F.upper(F.replace("event_type", F.lit("_"), F.lit(" - "))), F.lit(". "))
    return e.select(F.col("event_id").alias("pos"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("TIMESTAMP"), F.concat(F.lit(" u-"), F.col("user_id").cast("string")).alias("Application  ID"), said.alias("What happened?"))


FORM = {"timestamp": ["Timestamp"], "application_id": ["Application ID"], "event_type": ["What happened"], "medium": ["Medium"]}
FORM_SQL = "select event_id as pos, strftime(ts, '%Y-%m-%d %H:%M') as timestamp, 'U-' || user_id as application_id, upper(replace(event_type, '_', ' - ')) || '.' as event_type, '' as medium from events"


@query(
    "with s as (select 'u' || user_id || '-' || event_type as source_row_id, sha256(props) as payload, ts, event_id from events), f as (select source_row_id, arg_min(payload, (ts, event_id)) as first_payload from s group by 1) "
    "select source_row_id, first_payload, payload from s join f using (source_row_id) where payload != first_payload"
)
def payload_conflicts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    s = e.select(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("source_row_id"), F.sha2("props", 256).alias("payload_sha256"), "ts", "event_id")
    return intake_stream.payload_conflicts(s, ["ts", "event_id"])


@query(FORM_SQL)
def form_alias_read(spark, sf_dir):
    return intake.read_form(_form_rows(spark, sf_dir), FORM)


@query("select event_id, event_type as choice from events")
def choice_coerce(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    values = sorted(r[0] for r in e.select("event_type").distinct().collect())  # the vocabulary
    said = F.concat(F.lit(" "), F.upper(F.replace("event_type", F.lit("_"), F.lit(" / "))), F.lit("?"))
    return e.select("event_id", intake.coerce_choice(said, intake.choice_map(values, LABELS)).alias("choice"))


DATES_SQL = "case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then '' when 2 then strftime(o_orderdate, '%Y-02-30') else strftime(o_orderdate, '%d/%m/%Y') end"


def _dates() -> F.Column:
    k = F.col("o_orderkey") % 4
    return F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, "").when(k == 2, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-30"))).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))


@query(f"select o_orderkey, o_orderkey % 4 = 0 as required_ok, o_orderkey % 4 in (0, 1) as optional_ok, {DATES_SQL} as given from orders")
def iso_date_validate(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("given", _dates())
    return o.select("o_orderkey", tx.is_iso_date("given", True).alias("required_ok"), tx.is_iso_date("given").alias("optional_ok"), "given")


@query("select o_orderkey, strftime(o_orderdate::date + case o_orderstatus when 'F' then 30 when 'O' then 45 else 35 end, '%Y-%m-%d') as due_date from orders")
def due_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("filed", F.date_format("o_orderdate", "yyyy-MM-dd"))
    rules = spark.createDataFrame([("F", 30), ("O", 45)], "o_orderstatus string, days int")
    return o.join(F.broadcast(rules), "o_orderstatus", "left").select("o_orderkey", intake.due_date(F.col("filed"), F.coalesce("days", F.lit(35))).alias("due_date"))


def _submissions(spark, sf_dir) -> DataFrame:
    """Events as submissions, one id for each user and day; the payload is the event's kind."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_id").alias("pos"), F.date_format("ts", "yyyy-MM-dd").alias("timestamp"), F.concat(F.lit("U-"), F.col("user_id").cast("string")).alias("application_id"), "event_type")
    return rows.withColumn("source_row_id", intake.source_row_id("update")).withColumn("payload_sha256", F.sha2(F.concat_ws("|", "event_type"), 256))


SUBMISSIONS = "s as (select event_id as pos, strftime(ts, '%Y-%m-%d') as timestamp, 'U-' || user_id as application_id, event_type, substr(sha256('update|' || strftime(ts, '%Y-%m-%d') || '|U-' || user_id), 1, 16) as source_row_id, sha256(event_type) as payload_sha256 from events)"


@query(f"with {SUBMISSIONS}, seen as (select * from s where pos % 2 = 0), new as (select * from s where pos % 2 = 1 and source_row_id not in (select source_row_id from seen)) select source_row_id, min(pos) as pos, arg_min(event_type, pos) as event_type from new group by 1")
def ledger_new_vs_replay(spark, sf_dir):
    s = _submissions(spark, sf_dir)
    return intake.new_submissions(s.filter("pos % 2 = 1"), s.filter("pos % 2 = 0")).select("source_row_id", "pos", "event_type")


@query(f"with {SUBMISSIONS} select source_row_id, count(distinct payload_sha256) as payloads from s group by 1 having count(distinct payload_sha256) > 1")
def ledger_conflicts(spark, sf_dir):
    s = _submissions(spark, sf_dir)
    return intake.ledger_conflicts(s.filter("pos % 2 = 1"), s.filter("pos % 2 = 0"))


@query("with l as (select user_id, arg_max(event_type, event_id) as e, max(event_id) as m from events group by 1) select c_custkey, coalesce(e, c_mktsegment) as c_mktsegment, c_name from customer left join l on user_id = c_custkey")
def latest_submission_overlay(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("application_id"), F.col("event_type").alias("c_mktsegment"), F.col("event_id").alias("pos"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("application_id"), "c_mktsegment", "c_name")
    return intake.overlay(c, intake.latest_per_application(e).drop("pos"), "application_id").withColumnRenamed("application_id", "c_custkey")


@query("select 100 + row_number() over (order by event_id) as number, event_id, event_type, case when event_type in ('purchase', 'click') then 'outbound' else 'inbound' end as direction from events")
def event_append(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    numbered = intake.number_rows(e, "event_id", 100)
    return numbered.select(F.col("__number").alias("number"), "event_id", "event_type", F.when(F.col("event_type").isin("purchase", "click"), "outbound").otherwise("inbound").alias("direction"))


@query("select c_custkey as application_id, c_name, case when c_custkey % 5 = 0 then '' else 'kept' end as notes from customer")
def sync_added(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("application_id"), "c_name")
    state = intake.Intake(c.filter("application_id % 5 != 0").withColumn("notes", F.lit("kept")), c.limit(0), c.limit(0))
    return intake.sync_intake(state, c).applications


@query("select c_custkey::varchar as application_id, c_name, " + ", ".join(f"'' as {c}" for c in intake.OUTCOME_COLUMNS if c != "notes") + ", c_mktsegment as notes from customer")
def intake_start(spark, sf_dir):
    """A new intake's applications: outcome columns are blank, those at hand stay."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("application_id"), "c_name", F.col("c_mktsegment").alias("notes"))
    return intake.new_intake(c).applications


@query(
    "with s as (select o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') as d, o_orderstatus = 'F' as filed from orders), l as (select o_custkey, max(o_orderkey) as m from s group by 1) "
    "select c_custkey::varchar as application_id, case when m is null then '' when filed then 'filed' else 'not_filed' end as filing_outcome, case when filed then d else '' end as filing_date, case when m is null or filed then '' else 'portal_down' end as not_filed_reason, "
    "case when filed then strftime(d::date + case when c_nationkey < 5 then 30 else 45 end, '%Y-%m-%d') else '' end as due_date from customer left join l on o_custkey = c_custkey left join s on s.o_orderkey = m"
)
def filing_intake(spark, sf_dir):
    """Orders as a filing form put through the intake: the last of each application counts, with the response period of its state."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("application_id"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state"))
    filed = F.col("o_orderstatus") == "F"
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("timestamp"), F.col("o_custkey").cast("string").alias("application_id"), F.when(filed, "Yes").otherwise("Could not file").alias("filing_outcome"),
        F.when(filed, "").otherwise("Portal - down").alias("not_filed_reason"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("filing_date"), F.lit("").alias("payment_mode"),
    )
    words = {"filing_outcome": intake.choice_map(["filed", "not_filed"], {"Could not file": "not_filed"}, {"yes": "filed"}), "not_filed_reason": intake.choice_map(["portal_down"], {}), "payment_mode": intake.choice_map(["online"], {})}
    rules = spark.createDataFrame([*((f"S{k}", 30) for k in range(5)), ("_default", 45)], "state string, statutory_days int")
    done = intake.apply_form(intake.new_intake(c), rows, "filing", rules, words)
    return done.applications.select("application_id", "filing_outcome", "filing_date", "not_filed_reason", "due_date")


# --- release, letters, privacy -------------------------------------------------------------------------------------------------------------------


def _register(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("A-"), F.col("c_custkey").cast("string")).alias("application_id"), F.col("c_name").alias("authority_id"), F.concat(F.lit("b"), F.col("c_nationkey").cast("string")).alias("batch_id"), "c_mktsegment")


@query(
    "with d as (select 'A-' || c_custkey as application_id, c_name as authority_id, 'b' || c_nationkey as batch_id, c_mktsegment from customer where c_nationkey < 10 and c_custkey % 50 = 0) "
    "select application_id, authority_id, batch_id, c_mktsegment || '!' as c_mktsegment, 'left' as side from d union all select *, 'right' from d"
)
def publication_diff(spark, sf_dir):
    r = _register(spark, sf_dir)
    changed = F.when(F.regexp_extract("application_id", r"(\d+)$", 1).cast("long") % 50 == 0, F.concat("c_mktsegment", F.lit("!"))).otherwise(F.col("c_mktsegment"))
    frozen = r.filter("cast(substr(batch_id, 2) as int) < 10").withColumn("c_mktsegment", changed)
    return release.publication_differences(frozen, r)


@query(
    "with b as (select * from customer where c_nationkey = 3), i as (select * from customer where c_custkey % 4 = 0) select 'application' as kind, 'A-' || c_custkey as value from b where c_custkey in (select c_custkey from i) "
    "union all select 'office', c_name from b where c_name in (select c_name from i) union all select distinct 'batch', 'b3' from i where c_nationkey = 3"
)
def register_conflicts(spark, sf_dir):
    r = _register(spark, sf_dir)
    return release.register_conflicts(r.filter("batch_id = 'b3'"), r.filter("cast(substr(application_id, 3) as long) % 4 = 0"))


@query(
    "with d as (select c_custkey, c_name, c_mktsegment, n_name, printf('%.2f', c_acctbal) as balance, c_custkey % 2 = 0 as t from customer join nation on n_nationkey = c_nationkey) select c_custkey, 'To ' || c_name || ' (' || c_mktsegment || '), in ' || n_name || ': ' || balance || '. ' || "
    "case when t then 'The law sets 30 days for ' || c_name || '. ' else '' end || 'Yours, $1 \\1' as letter from d"
)
def render_letters(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    a = c.select("c_custkey", F.col("c_name").alias("office_name"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.format_string("%.2f", "c_acctbal").alias("balance"), F.col("c_custkey").alias("application_id"), F.when(F.col("c_custkey") % 2 == 0, "legal_salience").otherwise("plain").alias("treatment"))
    return letters.render_letters(a, LETTER, PARAGRAPH, {"filer_name": "$1 \\1"}, own_fields=True).select("c_custkey", "letter")


@query("select 'A-' || c_custkey as application_id, c_name as authority_id, 'b' || c_nationkey as batch_id from customer")
def public_projection(spark, sf_dir):
    return privacy.public_assignments(_register(spark, sf_dir).withColumn("notes", F.lit("private")))


CONTACT_SQL = f"regexp_matches(coalesce(text, ''), '{tx.EMAIL}') or regexp_matches(coalesce(text, ''), '{tx.PHONE}')"


@query(f"select doc_id, {CONTACT_SQL} as has_contact from documents")
def contact_scan(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.has_contact_details("text").alias("has_contact"))


@query(
    f"with f as (select case doc_id % 3 when 0 then 'renv/' else 'docs/' end || doc_id || '.txt' as path, text, doc_id from documents where doc_id % 7 != 0) select path, 'contact details' as reason from f where path not like 'renv/%' and ({CONTACT_SQL}) "
    f"union all select path, 'registration number' from f where path not like 'renv/%' and regexp_matches(coalesce(text, ''), '{tx.REGISTRATION}')"
)
def private_findings(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    files = d.select(F.concat(F.when(F.col("doc_id") % 3 == 0, "renv/").otherwise("docs/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), "doc_id")
    return privacy.private_findings(files.drop("doc_id"), files.filter("doc_id % 7 = 0").select("path", "sha256"))


@query("select 'region' as table_name, count(*) as rows, sha256(string_agg(r_regionkey || '|' || r_name, ';' order by r_regionkey)) as sha256 from region union all select 'nation', count(*), sha256(string_agg(n_nationkey || '|' || n_name, ';' order by n_nationkey)) from nation")
def checksum_rows(spark, sf_dir):
    def digest(name: str, key: str, label: str) -> DataFrame:
        row = F.concat_ws("|", F.col(key).cast("string"), label)
        rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(key), row.alias("v")))), lambda s: s["v"])  # dimension tables of fixed size
        return table(spark, sf_dir, name).agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(";", rows), 256).alias("sha256")).select(F.lit(name).alias("table_name"), "rows", "sha256")

    return digest("region", "r_regionkey", "r_name").union(digest("nation", "n_nationkey", "n_name"))


@query()
def source_digests(spark, sf_dir):
    """SHA-256 of all table files, compared with a manifest that has one wrong and names one that is missing."""
    found = readers.relative_digests(spark, sf_dir, "*.parquet")
    wrong = F.when(F.col("path") == "nation.parquet", F.lit("0")).otherwise(F.col("sha256"))
    gone = spark.createDataFrame([("gone.parquet", "0")], "path string, sha256 string")
    return readers.verify_manifest(found, found.withColumn("sha256", wrong).union(gone))


@query(
    "with a as (select 'N' || c_nationkey || '-' || c_custkey as application_id, 'N' || c_nationkey as state_code, c_name, c_mktsegment, 'b' || (c_custkey % 2) as batch_id from customer), f as (select c_name, min('O' || c_custkey) as authority_id from customer group by 1) "
    "select application_id, state_code, authority_id, c_mktsegment as dept_group, batch_id, 'batch' as randomization_stratum from a join f using (c_name)"
)
def catalogued_assignments(spark, sf_dir):
    """Two batches joined over the frame: checked, filled, offices looked up by state and name."""
    c = table(spark, sf_dir, "customer")
    state, key = F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), F.col("c_custkey").cast("string")
    frame = c.select(F.concat(F.lit("O"), key).alias("authority_id"), state.alias("state"), F.col("c_name").alias("office_name"))
    rows = c.select(F.concat_ws("-", state, key).alias("application_id"), state.alias("state"), F.col("c_name").alias("office_name"), F.col("c_mktsegment").alias("tree_department"), F.concat(F.lit("b"), (F.col("c_custkey") % 2).cast("string")).alias("batch_id"))
    parts = {b: rows.filter(F.col("batch_id") == b) for b in ("b0", "b1")}
    sizes = {r["batch_id"]: r["n"] for r in rows.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}  # two batches
    return release.combine_batches(parts, sizes, frame).select("application_id", "state_code", "authority_id", "dept_group", "batch_id", "randomization_stratum")


@query("select c_custkey::varchar as c_custkey, c_name, coalesce(nullif(c_mktsegment, 'BUILDING'), '') as c_mktsegment from customer")
def csv_round_trip(spark, sf_dir):
    """A table written as text CSV and read back: nulls are blanks, everything is text."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"))
    place = f"{shared.shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    readers.write_csv_text(c, place)
    return readers.read_csv_text(spark, place, c.columns)


@query("select n_name || '.csv' as path, sha256(n_name) as sha256, n_regionkey::varchar as region from nation")
def manifest_read(spark, sf_dir):
    """A manifest written as one file and read back."""
    place = f"{shared.shared_dir(spark)}/manifest-{uuid.uuid4().hex}.csv"
    readers.write_csv_file(table(spark, sf_dir, "nation").select(F.concat("n_name", F.lit(".csv")).alias("path"), F.sha2("n_name", 256).alias("sha256"), F.col("n_regionkey").alias("region")), place, ["path"])
    return readers.read_manifest(spark, place)


@query("select l_orderkey, w as weight, allocated from (with " + ONCE.format(g="l_orderkey", t="lineitem", n="(select count(*) // 3 from lineitem)") + " select g as l_orderkey, w, allocated from a)")
def alloc_many_groups(spark, sf_dir):
    """A third of all lines apportioned to their orders: beyond the groups that the driver takes, by distributed rounds."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("weight"))
    return allocate.apportion_once(g, table(spark, sf_dir, "lineitem").count() // 3, "l_orderkey", "weight")


@query(
    "select 'A-' || c_custkey as application_id, c_name as authority_id, 'b' || c_nationkey as batch_id, c_mktsegment from customer where c_nationkey < 10 or c_nationkey in (12, 20)"
)
def issued_register(spark, sf_dir):
    """Published batches and three private ones at hand, of which one is published already."""
    r = _register(spark, sf_dir)
    return release.read_issued(r.filter("cast(substr(batch_id, 2) as int) < 10"), [r.filter(F.col("batch_id") == b) for b in ("b9", "b12", "b20")])


@query("select 'A-' || c_custkey as application_id, c_name as authority_id, 'RA' || (c_nationkey % 4) as assigned_ra, 'RA' || (c_nationkey % 4) as ra from customer")
def worklists(spark, sf_dir):
    """Worklists by assistant, written and read back."""
    place = f"{shared.shared_dir(spark)}/worklists-{uuid.uuid4().hex}"
    assistant = F.concat(F.lit("RA"), (F.substring("batch_id", 2, 9).cast("int") % 4).cast("string"))
    release.write_worklists(_register(spark, sf_dir).select("application_id", "authority_id", assistant.alias("assigned_ra")), place)
    return spark.read.option("header", True).schema("application_id string, authority_id string, assigned_ra string, ra string").csv(place)


@query(
    "select 'assignments' as table_name, 'A-' || c_custkey as key, c_name as name from customer union all select 'authorities', 'O-' || s_suppkey, s_name from supplier "
    "union all select 'rows', 'assignments', count(*)::varchar from customer union all select 'rows', 'authorities', count(*)::varchar from supplier"
)
def release_tables(spark, sf_dir):
    """A release built from verified table files: both published files read back, and the rows its checksums state."""
    place = f"{shared.shared_dir(spark)}/release-{uuid.uuid4().hex}"
    files = readers.relative_digests(spark, sf_dir, "*.parquet")
    frame = table(spark, sf_dir, "supplier").select(F.concat(F.lit("O-"), F.col("s_suppkey").cast("string")).alias("authority_id"), F.col("s_name").alias("office_name"), F.col("s_phone").alias("pio_phone") if "s_phone" in table(spark, sf_dir, "supplier").columns else F.lit("x").alias("pio_phone"))
    sums = release.build_release(files, files, frame, _register(spark, sf_dir), place)
    offices, rows = (readers.read_csv_text(spark, f"{place}/{n}.csv") for n in ("authorities", "assignments"))
    parts = [rows.select(F.lit("assignments").alias("table_name"), F.col("application_id").alias("key"), F.col("authority_id").alias("name")), offices.select(F.lit("authorities"), "authority_id", "office_name"), sums.select(F.lit("rows"), "table", F.col("rows").cast("string"))]
    return parts[0].union(parts[1]).union(parts[2])


@query("select s_nationkey as batch, count(*) as files, sum(length('To ' || s_name || '.'))::bigint as characters from supplier group by 1")
def letter_files(spark, sf_dir):
    """A letter for every supplier, put out by the tasks as a file each and read back."""
    s = table(spark, sf_dir, "supplier")
    place = f"{shared.shared_dir(spark)}/letters-{uuid.uuid4().hex}"
    a = s.select(F.concat(F.lit("A-"), F.col("s_suppkey").cast("string")).alias("application_id"), F.concat(F.lit("RA"), F.col("s_nationkey").cast("string")).alias("assigned_ra"), F.col("s_name").alias("office_name"), F.lit("plain").alias("treatment"))
    letters.write_letters(letters.render_letters(a, "To {office_name}.", "", {}), f"{place}/table")
    letters.export_letters(spark, f"{place}/table", f"{place}/files")
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(f"{place}/files", wholetext=True)
    batch = F.regexp_extract(F.col("_metadata.file_path"), "/RA([0-9]+)/[^/]*$", 1).cast("int")
    return found.groupBy(batch.alias("batch")).agg(F.count("*").alias("files"), F.sum(F.char_length("value")).cast("long").alias("characters"))


# --- HTML, JSON, trees, browsing -----------------------------------------------------------------------------------------------------------------


@query(r"select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, len(regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1)) as n_links, coalesce(list_aggregate(regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1), 'string_agg', ' '), '') as links from pages")
def html_links_extract(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit(r'<li><a href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), long(F.size(links)).alias("n_links"), F.concat_ws(" ", links).alias("links"))


@query("select n_nationkey, 'v' || n_nationkey as value, n_name || ' &amp; Co' as label from nation")
def html_select_options(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit('<SELECT class="f" name="MinistryId"><option value="0">--Select--</option><option  class="x" value="v'), F.col("n_nationkey").cast("string"), F.lit('">  <b>'), "n_name", F.lit("</b>  &amp;\n Co </option></SELECT>")).alias("page"))
    return n.select("n_nationkey", F.explode(readers.select_options(F.col("page"))).alias("o")).select("n_nationkey", "o.value", "o.label")


def _portal_pages(spark, sf_dir) -> DataFrame:
    """Portal pages of at most 200 offices: suppliers by nation and range of keys, every third with sub-offices."""
    s = table(spark, sf_dir, "supplier").withColumn("row", F.concat(
        F.lit("<tr><td>"), F.col("s_suppkey").cast("string"), F.lit('</td><td><div class="text-primary">'), "s_name", F.lit("</div><div>Hall "), F.col("s_nationkey").cast("string"), F.lit("</div></td><td>"),
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit('<a href="/show_sub_office/'), F.col("s_suppkey").cast("string"), F.lit('">more</a>'))).otherwise(""), F.lit("</td></tr>"),
    ))
    pages = s.groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 200)).agg(F.concat_ws("", F.collect_list("row")).alias("rows"))
    return pages.select(F.col("s_nationkey").alias("nation"), F.lit("https://portal.example.org/list").alias("url"), F.concat(F.lit("<table><tr><th>No</th><th>Office</th></tr>"), "rows", F.lit("</table>")).alias("html"))


OFFICE_SQL = "select s_nationkey as nation, s_name as office_name, 'Hall ' || s_nationkey as address, case when s_suppkey % 3 = 0 then 'https://portal.example.org/show_sub_office/' || s_suppkey else '' end as office_url, s_suppkey % 3 != 0 as is_leaf from supplier"


@query(OFFICE_SQL)
def html_office_rows(spark, sf_dir):
    return readers.parse_office_pages(_portal_pages(spark, sf_dir)).select("nation", "office_name", "address", "office_url", "is_leaf")


@query(OFFICE_SQL)
def html_office_table_function(spark, sf_dir):
    """The same by the table function in SQL."""
    readers.register_office_rows(spark)
    return spark.sql("select p.nation, o.* from {pages} p, lateral office_rows(p.html, p.url) o", pages=_portal_pages(spark, sf_dir))


@query("select 'Office ' || s_name as office_name from supplier union select 'Hall ' || s_nationkey from supplier")
def json_page_names(spark, sf_dir):
    """Names of JSON pages that hold raw control characters."""
    s = table(spark, sf_dir, "supplier")
    page = F.concat(F.lit('["Office\t'), "s_name", F.lit('", " Hall \n'), F.col("s_nationkey").cast("string"), F.lit('"]'))
    return readers.json_names(s.select(page.alias("json")))


@query("select distinct s_name || ' of ' || s_nationkey as office_name from supplier")
def html_portal_rows(spark, sf_dir):
    """Second cells of the rows of portal tables, one of them around an inner table."""
    s = table(spark, sf_dir, "supplier")
    row = F.concat(F.lit("<tr><td>1</td><td> "), "s_name", F.lit("  <table><tr><td>of "), F.col("s_nationkey").cast("string"), F.lit("</td></tr></table></td></tr>"))
    return readers.portal_rows(s.select(F.concat(F.lit("<table><tr><th>No</th><th>Name</th></tr>"), row, F.lit("</table>")).alias("html")))


@query(
    r"select page_id, md5(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\n\r]+', ' ', 'g')), ' +', ' ', 'g')) as text_md5 from pages"
)
def html_text(spark, sf_dir):
    """All readable text of pages without its markup, as a digest."""
    bare = F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]*>", " ")
    return table(spark, sf_dir, "pages").select("page_id", F.md5(F.trim(F.regexp_replace(bare, r"[ \t\n\r]+", " ")).cast("binary")).alias("text_md5"))


@query("select event_id, (props->>'k')::bigint as k from events")
def json_props_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


TREE_SQL = (
    "with recursive e as (select 'r' || r_regionkey as node, '' as parent, r_name as name from region union all select 'n' || n_nationkey, 'r' || n_regionkey, n_name from nation union all select 's' || s_suppkey, 'n' || s_nationkey, s_name from supplier), "
    "t as (select node, 0::bigint as depth, name as path from e where parent = '' union all select e.node, depth + 1, path || ' > ' || e.name from t join e on e.parent = t.node) select node, depth, path from t"
)


@query(TREE_SQL)
def tree_paths(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = t("region").select(tag("r", "r_regionkey").alias("node"), F.lit("").alias("parent"), F.col("r_name").alias("name"))
    edges = edges.union(t("nation").select(tag("n", "n_nationkey"), tag("r", "n_regionkey"), "n_name")).union(t("supplier").select(tag("s", "s_suppkey"), tag("n", "s_nationkey"), "s_name"))
    return tree.closure(edges).withColumn("depth", long("depth"))


@query("select s_suppkey, substr(sha1('n' || s_nationkey || '|' || upper(s_name) || '|HALL'), 1, 16) as leaf_id, substr(sha1(upper('Top > ' || s_name)), 1, 16) as inner_id from supplier")
def crawl_node_ids(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    parent, path = F.concat(F.lit("n"), F.col("s_nationkey").cast("string")), tree.child_path(F.lit("Top"), F.col("s_name"))
    make = lambda leaf: tree.node_id(parent, F.col("s_name"), F.lit("Hall"), path, F.lit(leaf))
    return s.select("s_suppkey", make(True).alias("leaf_id"), make(False).alias("inner_id"))


@query("select 'c_mktsegment' as facet, c_mktsegment as value from customer group by 2 union all select 'c_nationkey', c_nationkey::varchar from customer group by 2")
def facets(spark, sf_dir):
    return browse.facet_values(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


@query("select c_custkey, c_name from customer where c_mktsegment = 'BUILDING' and contains(lower(c_custkey || ' ' || c_name), '1')")
def facet_filter(spark, sf_dir):
    return browse.facet_filter(table(spark, sf_dir, "customer"), {"c_mktsegment": "BUILDING", "c_nationkey": None}, "1", ("c_custkey", "c_name")).select("c_custkey", "c_name")


@query("select count(*) filter (where c_mktsegment = 'BUILDING' and contains(lower(c_custkey || ' ' || c_name), '7')) as visible, count(*) as total from customer")
def visible_count(spark, sf_dir):
    return browse.visible_count(table(spark, sf_dir, "customer"), {"c_mktsegment": "BUILDING"}, "7", ("c_custkey", "c_name"))


@query("select n_nationkey as batch_id, n_name from nation where n_nationkey in (select c_nationkey from customer where c_mktsegment = 'MACHINERY')")
def instrument_semi(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_nationkey").alias("batch_id"))
    return browse.instruments_in_view(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("batch_id"), "n_name"), rows)


@query("select event_type, case event_type when 'view' then 'Viewed' when 'purchase' then 'Bought' else event_type end as label, count(*) as n from events group by 1")
def facet_labels(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("label", browse.label(F.col("event_type"), {"view": "Viewed", "purchase": "Bought"}))


# --- frames --------------------------------------------------------------------------------------------------------------------------------------


@query(
    "with o as (select s_suppkey, s_name as office_name, lower(regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g')) as k from supplier), l as (select arg_max(s_nationkey, s_suppkey) as d, lower(regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g')) as k from supplier where s_suppkey % 2 = 0 group by 2), "
    "f as (select distinct office_name, k from o) select office_name, 'TG' as state_code, case when l.k is null then '' else 'D' || d end as district from f left join l using (k)"
)
def flat_frame_lookup(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    legacy = s.filter("s_suppkey % 2 = 0").select(F.upper("s_name").alias("office_name"), F.concat(F.lit("D"), F.col("s_nationkey").cast("string")).alias("district"), F.lit("").alias("block"), F.col("s_suppkey").alias("pos"))
    return frames.flat_frame(s.select(F.col("s_name").alias("office_name")).distinct(), legacy, "TG", "Telangana", "portal").select("office_name", "state_code", "district")


@query(
    "with k as (select s_suppkey, lower('Karnataka|' || s_name || '|d' || s_nationkey || '|') as key, s_name, s_nationkey from supplier) select 'KA' as state_code, substr(sha256(key), 1, 12) as authority_id, s_name as office_name, 'd' || s_nationkey as district, '' as node_id from k "
    "union all select 'TN', 'TN-' || p_partkey, p_name, case when p_size % 7 = 0 then '' else 'd' || p_size end, p_partkey::varchar from part"
)
def state_frames(spark, sf_dir):
    """The frame of two states: one from a portal list, one from a categorised tree whose offices keep their nodes' identifiers."""
    s, p = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    listed = s.select(F.col("s_name").alias("office_name"), F.lit("KA").alias("state_code"), F.lit("Karnataka").alias("state"), F.concat(F.lit("d"), F.col("s_nationkey").cast("string")).alias("district"), F.col("s_suppkey").alias("pos"))
    nodes = p.select(F.col("p_name").alias("office_name"), F.col("p_partkey").alias("node_id"), F.col("p_type").alias("tier"), F.col("p_brand").alias("tree_department"), F.col("p_partkey").alias("pos"))
    place = F.when(F.col("p_size") % 7 == 0, "n/a").otherwise(F.concat(F.lit("d"), F.col("p_size").cast("string")))
    places = p.select(F.concat(F.lit(" "), F.upper("p_name")).alias("office_name"), place.alias("district"), F.lit("-").alias("block"), F.col("p_partkey").alias("pos"))
    found = frames.build_frames({"KA": listed, "TN": frames.categorized_frame(nodes, places, "TN", "Tamil Nadu", "portal")})
    return found.select("state_code", "authority_id", "office_name", "district", "node_id")


@query(
    "with c as (select p_brand || ' ' || p_size as g, count(*) as n from part group by 1) select case when n < 5 then 'OTHER' else g end as dept_group, sum(n)::bigint as n from c group by 1"
)
def pooled_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_brand", F.col("p_size").cast("string")).alias("dept_group"))
    return frames.pool_small_groups(p, "dept_group").groupBy("dept_group").agg(F.count("*").alias("n"))


# --- analyses ------------------------------------------------------------------------------------------------------------------------------------


@query("select user_id, arg_max(event_type, (ts, event_id)) as status, max(ts) as status_at from events group by 1")
def status_view(spark, sf_dir):
    return analytics.current_status(table(spark, sf_dir, "events"), "user_id", "event_type", "ts", "event_id")


@query(
    "with s as (select user_id, min(ts) as start from events group by 1), f as (select user_id, min(ts) filter (where event_type = 'purchase') as p, min(ts) filter (where event_type = 'click') as c from events group by 1) "
    "select user_id, date_diff('day', start::date, c::date) as days_to_click, date_diff('day', start::date, p::date) as days_to_purchase from s left join f using (user_id)"
)
def days_to_event(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return analytics.days_to_event(e.groupBy("user_id").agg(F.min("ts").alias("start")), e, "user_id", "start", "event_type", "ts", ["click", "purchase"])


@query(
    "with d as (select o_orderkey, date_diff('day', o_orderdate::date, min(l_shipdate)::date) as days from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_orderdate) "
    "select o_orderkey, days, coalesce(days <= 30, false) as answered, coalesce(least(days, 90), 90)::bigint as follow_up from d"
)
def response_flags(spark, sf_dir):
    """Whether an order's first line followed within 30 days, and its delay cut off at 90."""
    first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("shipped"))
    o = table(spark, sf_dir, "orders").join(first, "o_orderkey", "left")
    delays = o.select("o_orderkey", long(F.date_diff(F.to_date("shipped"), F.to_date("o_orderdate"))).alias("days"))
    return analytics.answered_within(delays, "days", 30, 90).withColumn("follow_up", long("follow_up"))


@query(
    "with o as (select o_custkey, count(*) filter (where o_orderstatus = 'F') as f, count(*) filter (where o_orderstatus = 'P') as p, count(*) filter (where o_orderpriority = '1-URGENT') as u from orders group by 1) "
    "select c_custkey, case when f > 4 then 'format_a_application_level' when p > 0 then 'format_b_monthly' when u > 0 then 'format_c_period_totals' when c_acctbal > 0 then 'narrative_only' else 'none' end as data_granularity from customer left join o on o_custkey = c_custkey"
)
def data_granularity(spark, sf_dir):
    """What each customer's orders would be coded as, were they a response."""
    n = lambda test: F.count_if(F.expr(test))
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(n("o_orderstatus = 'F'").alias("f"), n("o_orderstatus = 'P'").alias("p"), n("o_orderpriority = '1-URGENT'").alias("u"))
    c = table(spark, sf_dir, "customer").join(o, "c_custkey", "left")
    text = F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(" ")
    return c.select("c_custkey", analytics.granularity(F.col("f") - 4, F.col("p"), F.col("u"), text).alias("data_granularity"))


KM_SQL = (
    "with s as (select user_id, date_diff('day', min(ts)::date, max(ts)::date) as last_day, date_diff('day', min(ts)::date, (min(ts) filter (where event_type = 'purchase'))::date) as d from events group by 1), r as (select coalesce(d, last_day) as time, d is not null as ev from s), "
    "t as (select time, count(*) as l, count(*) filter (where ev) as events from r group by 1), k as (select time, sum(l) over (order by time desc)::bigint as at_risk, events from t), e as (select * from k where events > 0) "
    "select time, at_risk, events, round(case when max(case when events = at_risk then 1 else 0 end) over (order by time) = 1 then 0.0 else exp(sum(case when events < at_risk then ln(1 - events / at_risk::double) else 0 end) over (order by time)) end, 9) as survival from e"
)


@query(KM_SQL)
def km_survival(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    s = e.groupBy("user_id").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("hit"))
    rows = s.select(long(F.date_diff(F.coalesce(F.to_date("hit"), F.to_date("end")), F.to_date("start"))).alias("time"), F.col("hit").isNotNull().alias("event"))
    return analytics.kaplan_meier(rows, "time", "event").withColumn("survival", F.round("survival", 9))


@query(DRAW + ", w as (select c_mktsegment, count(*) as frame_n from customer group by 1) select c_mktsegment, frame_n, count(*) as drawn_n, round(frame_n / count(*)::double, 9) as weight from assigned join w using (c_mktsegment) group by 1, 2")
def inclusion_weights(spark, sf_dir):
    return analytics.inclusion_weights(table(spark, sf_dir, "customer"), _drawn(spark, sf_dir), ["c_mktsegment"]).withColumn("weight", F.round("weight", 9))


@query(
    "with g as (select o_custkey, count(*)::bigint as n, avg((o_orderstatus = 'F')::int::double) as rate from orders group by 1), m as (select sum(n * rate) / sum(n) as mean, var_pop(rate) as spread, avg(1.0::double / n) as inv from g), p as (select *, greatest(spread - mean * (1 - mean) * inv, 1e-9) as prior from m) "
    "select o_custkey, n, round(rate, 9) as rate, round(prior / (prior + mean * (1 - mean) / n) * rate + (1 - prior / (prior + mean * (1 - mean) / n)) * mean, 6) as shrunken from g, p"
)
def shrunken_rates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("late", F.col("o_orderstatus") == "F")
    return analytics.shrunken_rates(o, "o_custkey", "late").withColumn("rate", F.round("rate", 9)).withColumn("shrunken", F.round("shrunken", 6))


@query(
    "with r as (select (o_orderstatus = 'F')::int::double as y, (o_custkey % 2)::double as d, o_orderpriority as s, o_custkey as c from orders), x as (select y - avg(y) over (partition by s) as y, d - avg(d) over (partition by s) as d, c from r), b as (select sum(d * y) / sum(d * d) as effect, sum(d * d) as ss from x), "
    "u as (select c, sum(d * (y - effect * d)) as s from x, b group by c) select round(effect, 8) as effect, round(sqrt(sum(s * s)) / ss, 8) as std_error, count(*) as clusters from u, b group by effect, ss"
)
def treatment_effect(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_orderstatus") == "F").alias("late"), (F.col("o_custkey") % 2).alias("treated"), "o_orderpriority", "o_custkey")
    found = analytics.within_effect(o, "late", "treated", "o_orderpriority", "o_custkey")
    return found.select(F.round("effect", 8).alias("effect"), F.round("std_error", 8).alias("std_error"), "clusters")


@query(f"select c_custkey from customer where ('0x' || substr(md5('{SEED}|' || c_custkey), 1, 8))::bigint % 100 < 50")
def appeal_subsample(spark, sf_dir):
    return analytics.appeal_subsample(table(spark, sf_dir, "customer"), "c_custkey", SEED).select("c_custkey")


@query("select doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x09-\\x0D ]+')) as n_words, len(regexp_extract_all(coalesce(text, ''), '[^\\x09-\\x0D ]+')) <= 150 as fits from documents")
def portal_word_limit(spark, sf_dir):
    n = letters.word_count("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(n, F.lit(0)).alias("n_words"), (F.coalesce(n, F.lit(0)) <= 150).alias("fits"))


@query("with a as (select c_nationkey as k, avg(c_acctbal) as v from customer group by 1), b as (select s_nationkey as k, avg(s_acctbal) as v from supplier group by 1) select k, round(a.v, 6) as reported, round(b.v, 6) as measured, round(a.v - b.v, 6) as difference from a join b using (k)")
def paired_difference(spark, sf_dir):
    a = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.avg("c_acctbal").alias("v"))
    b = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.avg("s_acctbal").alias("v"))
    found = analytics.paired_difference(a, b, "k", "v")
    return found.select("k", *[F.round(c, 6).alias(c) for c in ("reported", "measured", "difference")])


@query("select strftime(ts, '%Y-%m-%d') as day, count(*) as n from events group by 1")
def arrivals_per_day(spark, sf_dir):
    """The batch form of the streaming window count."""
    found = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 day")).agg(F.count("*").alias("n"))
    return found.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n")


@query()
def ledger_stream(spark, sf_dir):
    """Events as a stream of submissions through the ledger: the first of each id."""
    events = table(spark, sf_dir, "events")
    place = f"{shared.shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")
    rows = stream.select(F.date_format("ts", "yyyy-MM-dd").alias("timestamp"), F.concat(F.lit("U-"), F.col("user_id").cast("string")).alias("application_id"))
    rows = intake_stream.ledger_stream(rows.withColumn("source_row_id", intake.source_row_id("update")))
    intake_stream.run_available(rows, intake_stream.to_folder(f"{place}/out"), f"{place}/checkpoint")
    return spark.read.schema("timestamp string, application_id string, source_row_id string, batch int").parquet(f"{place}/out").drop("batch")
