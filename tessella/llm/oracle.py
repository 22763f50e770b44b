"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

import string

from tessella.llm.hilbert import BITS, DIMENSIONS, curve_tables
from tessella.llm.mixing import BLOCK_ROWS

def _crc_table() -> list[int]:
    """Remainders of every byte under the reversed polynomial EDB88320."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def hilbert_sql(shards: int = 24) -> str:
    """DuckDB SQL for the shards: the checksum folds over the text's bytes, the curve over the levels of its codes."""
    digits, states = curve_tables(len(DIMENSIONS))
    octets = "list_prepend(4294967295::bigint, list_transform(range(0, length(x)::bigint, 2), lambda i: ('0x' || substr(x, (i + 1)::bigint, 2))::bigint))"
    crc = f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, ({_crc_table()}::bigint[])[(xor(c, b) & 255) + 1])), 4294967295)"
    code = lambda c: f"case when {c} is null then 0 else 1 + ('0x' || substr(md5({c}), 1, 8))::bigint % {(1 << BITS) - 1} end"
    sql = (
        f"with d as (select doc_id, (coalesce(strlen(text), 0) + 8)::bigint as size, hex(encode(text)) as x, {code('source')} as source_code, {code('lang')} as lang_code from documents), "
        f"l{BITS} as (select doc_id, size, {crc} as text_crc32, source_code, lang_code, least({(1 << BITS) - 1}, 2 * length(bin(size)) + substr(bin(size), 2, 1)::int) as size_code, 0 as state, 0::bigint as h from d)"
    )
    for level in range(BITS - 1, -1, -1):
        at = "state * 8 + " + " + ".join(f"(({c} >> {level}) & 1) * {1 << k}" for k, c in enumerate(DIMENSIONS)) + " + 1"
        sql += f", l{level} as (select * exclude (state, h), {states}[{at}] as state, h * 8 + {digits}[{at}] as h from l{level + 1})"
    return (
        sql + ", r as (select *, row_number() over (order by h, doc_id nulls first, size, text_crc32 nulls first) - 1 as rank, count(*) over () as total from l0) "
        f"select doc_id, size, text_crc32, 'rows' as law, (rank * {shards} // total)::int as shard, (rank - (rank * {shards} // total * total + {shards - 1}) // {shards})::bigint as slot, null::int as grown_shard, "
        "h::bigint as hilbert, source_code::int as source_code, lang_code::int as lang_code, size_code::int as size_code from r"
    )


def mixing_sql(entropy: float = 0.98, max_repeats: float = 2.0, seed: int = 17) -> str:
    """DuckDB SQL for the mixture at its default settings: plain bisection, then budgets and block permutations."""
    return f"""
with recursive t as (select doc_id, source, coalesce('=' || source, 'null') as source_key, case when doc_id is null then md5(coalesce(text, '')) end as spread, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as tokens from documents),
s as (select source_key, count(*) as source_rows, sum(tokens)::bigint as source_tokens from t group by 1),
f as (select count(*) as n, sum(source_tokens)::double as total, min(source_tokens) / sum(source_tokens)::double as lo, max(source_tokens) / sum(source_tokens)::double as hi, list(source_tokens / (select sum(source_tokens) from s)::double) as p from s where source_tokens > 0),
e as (select 0 as step, 0.0::double as low, 1.0::double as high union all
  select step + 1, case when ok then low else (low + high) / 2 end, case when ok then (low + high) / 2 else high end from (select *, ln(list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2)))) - (low + high) / 2 * list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2) * ln(x))) / list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))) <= {entropy} * ln(n) + 1e-12 as ok from e, f) where step < 50),
r as (select 0 as step, 0.0::double as low, 1.0::double as high union all
  select step + 1, case when ok then low else (low + high) / 2 end, case when ok then (low + high) / 2 else high end from (select *, pow(hi / lo, 1 - (low + high) / 2) <= {max_repeats} * (1 + 1e-12) as ok from r, f) where step < 50),
a as (select case when n < 2 then 1.0 else ceil(greatest((select case when high < 1e-9 then 0.0 else high end from e where step = 50), (select case when high < 1e-9 then 0.0 else high end from r where step = 50)) * 1e6 - 1e-4) / 1e6 end as alpha, total, hi from f),
w as (select source_key, source_rows, source_tokens, case when source_tokens > 0 then pow(source_tokens / total, alpha) else 0.0 end as raised, alpha, total, hi from s, a),
z as (select *, raised / sum(raised) over () as weight, total * sum(raised) over () * pow(hi, 1 - alpha) as spent from w),
b as (select source_key, source_rows, source_tokens, weight, round(weight * spent)::bigint as budget, ceil(source_rows / {BLOCK_ROWS})::bigint as blocks from z),
pl as (select *, case when source_tokens > 0 then budget // source_tokens else 1 end as epochs, case when source_tokens > 0 then budget % source_tokens else 0 end as rest from b),
dealt as (select doc_id, source, tokens, spread, pl.*, unnest(range(0, epochs + case when rest > 0 then 1 else 0 end)) as epoch, ('0x' || substr(md5('{seed}|block|' || coalesce(doc_id::varchar, spread)), 1, 8))::bigint % blocks as block from t join pl using (source_key)),
bl as (select source_key, epoch, block, sum(tokens) as block_tokens from dealt group by 1, 2, 3),
st as (select source_key, epoch, block, coalesce(sum(block_tokens) over (partition by source_key, epoch order by md5('{seed}|' || epoch || '|' || source_key || '|' || block), block rows between unbounded preceding and 1 preceding), 0) as block_start from bl),
pd as (select dealt.*, block_start + coalesce(sum(tokens) over (partition by source_key, epoch, block order by md5('{seed}|' || epoch || '|' || coalesce(doc_id::varchar, 'null')), doc_id, tokens, spread rows between unbounded preceding and 1 preceding), 0) as start, block_start from dealt join st using (source_key, epoch, block))
select doc_id, source, tokens, round(weight, 9) as weight, budget, epoch::int as epoch, block, round(case when budget > 0 then (epoch * source_tokens + start) / budget::double else 0.0 end, 9) as position from pd where epoch < epochs or start < rest
"""


def near_duplicates_sql(percent: int = 80) -> str:
    """DuckDB SQL for two-word shingles: exact intersections by a join on shingles, components by closure over the links."""
    return f"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end as g from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select x.doc_id as a, y.doc_id as b, count(*) as common from s x join s y on x.g = y.g and x.doc_id != y.doc_id group by 1, 2),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * common >= {percent} * (na.n + nb.n - common)),
r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
c as (select a, min(b) as b from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(c.b, d.doc_id)) as component_id, coalesce(c.b >= d.doc_id, true) as kept from d left join n using (doc_id) left join c on c.a = d.doc_id
"""


def similar_sets_sql(words: int = 4, percent: int = 85) -> str:
    """DuckDB SQL for shingles of `words` words: exact intersections by a join on shingles, components by closure over the links."""
    return f"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:least(i + {words - 1}, len(w))], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select x.doc_id as a, y.doc_id as b, count(*) as common from s x join s y on x.g = y.g and x.doc_id != y.doc_id group by 1, 2),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * common >= {percent} * (na.n + nb.n - common)),
r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
c as (select a, min(b) as b from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(c.b, d.doc_id)) as component_id from d left join n using (doc_id) left join c on c.a = d.doc_id
"""


def balls_sql(k: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64) -> str:
    """DuckDB SQL for the clusters: every vector is compared with every centroid in every round."""
    nearest = (
        "a{r} as materialized (select vec_id, x, q, min_by(c, (d, c)) as c, min(d) as d from (select v.vec_id, v.x, v.q, k.c, list_sum(list_transform(range(1, {n} + 1), lambda i: (v.x[i] - k.x[i]) * (v.x[i] - k.x[i])))::bigint as d "
        "from v, k{r} k) group by 1, 2, 3)"
    )
    moved = (
        "k{s} as materialized (select k{r}.c, coalesce(m.x, k{r}.x) as x from k{r} left join (select c, list(floor_mean order by i) as x from (select c, i, ((sum(e) - (((sum(e) % count(*)) + count(*)) % count(*))) // count(*))::bigint as floor_mean "
        "from (select c, unnest(x) as e, unnest(range(1, {n} + 1)) as i from a{r}) group by c, i) group by c) m on m.c = k{r}.c)"
    )
    steps = []
    for r in range(rounds):
        steps += [nearest.format(r=r, n=dimensions), moved.format(r=r, s=r + 1, n=dimensions)]
    steps.append(nearest.format(r=rounds, n=dimensions))
    return (
        f"with v as materialized (select vec_id, list_transform(embedding, lambda e: floor({scale} * e::double)::bigint) as x, row_number() over () as q from embeddings where len(embedding) = {dimensions} "
        "and len(list_filter(embedding, lambda e: e is not null and isfinite(e::double))) = len(embedding)), "
        f"k0 as materialized (select row_number() over (order by h nulls last, x) - 1 as c, x from (select sha256('1:' || vec_id) as h, x from v order by 1 nulls last, 2 limit {k})), {', '.join(steps)} "
        f"select vec_id, a.c::int as cluster, d as distance, sum(d) over (partition by a.c)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia, sha256(array_to_string(k.x, ',')) as centroid_sha256 from a{rounds} a join k{rounds} k on k.c = a.c"
    )
