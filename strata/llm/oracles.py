"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

import zlib

from strata.llm.mixing import MixConfig
from strata.llm.sharding import ROW_OVERHEAD_BYTES, Node, default_tree
from strata.llm.url_filter import Rule, default_rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def url_filter_sql(rules: list[Rule] | None = None) -> str:
    """Every rule's expression against every URL."""
    rules = default_rules() if rules is None else rules
    values = ", ".join(f"({i}, {_text(r.name)}, {_text(r.verdict)}, {_text(r.regex)}, {r.listed}, {r.size})"
                       for i, r in enumerate(rules))
    return f"""
with r(rule_id, name, verdict, regex, listed, size) as (values {values}),
p as (select row_number() over () as n, page_id,
             case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as tail from pages),
q as (select n, page_id, translate(regexp_extract(tail, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') as host,
             regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(tail, '(?s)^[^?#]*(.*)\\z', 1) as rest from p),
m as (select q.n, r.*, row_number() over (partition by q.n order by r.listed desc, r.size desc, r.rule_id) as k
      from q join r on q.host || q.path || q.rest <> '' and regexp_matches(q.host || q.path || q.rest, r.regex))
select page_id, host, path, case when listed then name end as rule, coalesce(verdict, 'allow') as verdict,
       case when not listed then name end as pattern
from q left join (select * from m where k = 1) b on q.n = b.n
"""


def mixing_sql(config: MixConfig = MixConfig()) -> str:
    """The same budgets level by level, and plain running sums per leaf."""
    levels = ("domain", "lang", "source")
    weights = {"domain": config.domain_weights, "lang": config.lang_weights, "source": config.source_weights}

    def weight(name: str) -> str:
        cases = " ".join(f"when {name} = {_text(k)} then {float(v)}" for k, v in sorted(weights[name].items()))
        return f"case {cases} else {float(config.default_weight)} end" if cases else f"{float(config.default_weight)}"

    parts, parent = [], []
    for i, name in enumerate(levels):
        key = ", ".join([*parent, name])
        by = f"partition by {', '.join(parent)}" if parent else ""
        budget = "(select b from total)" if i == 0 else "a.share"
        join = "" if i == 0 else f" join s{i - 1} a on " + " and ".join(f"g.{k} is not distinct from a.{k}" for k in parent)
        own = ", ".join(f"g.{k}" for k in [*parent, name])
        parts.append(f"""
s{i} as (
  with n as (select {own}, g.supply, g.w, {budget} as budget, case when g.w > 0 then g.supply / g.w end as r
             from (select {key}, sum(tokens) * {config.max_epochs} as supply, {weight(name)} as w from leaves group by {key}) g{join}),
  f as (select *, coalesce(sum(case when w > 0 then supply else 0 end) over ({by} order by r nulls last, {name} nulls first
                            rows between unbounded preceding and 1 preceding), 0) as was,
               sum(w) over ({by} order by r nulls last, {name} nulls first rows between current row and unbounded following) as rest from n),
  l as (select *, case when rest > 0 and (budget - was) / rest <= r then (budget - was) / rest end as candidate from f),
  m as (select *, max(candidate) over ({by or 'partition by 1'}) as level from l)
  select {key}, cast(floor(case when w > 0 then least(cast(supply as double), coalesce(level * w, cast(supply as double))) else 0 end + 1e-6) as bigint) as share
  from m)""")
        parent.append(name)
    return f"""
with d as (select doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n_tokens,
                  try_cast(regexp_extract(coalesce(source, ''), '(\\d{{1,9}})$', 1) as bigint) % 3 as k from documents),
rows_ as (select doc_id, lang, source, n_tokens, case when k = 1 then 'reference' when k = 2 then 'forum' else 'web' end as domain from d),
leaves as (select domain, lang, source, sum(n_tokens) as tokens from rows_ group by domain, lang, source),
total as (select cast(floor(coalesce(sum(tokens), 0) * {config.budget_share}) as bigint) as b from leaves),
{",".join(parts)},
plan as (select l.domain, l.lang, l.source, s.share // greatest(l.tokens, 1) as epochs, s.share % greatest(l.tokens, 1) as rest
         from leaves l join s2 s on l.domain is not distinct from s.domain and l.lang is not distinct from s.lang
                                and l.source is not distinct from s.source),
placed as (select r.*, p.epochs, p.rest,
                  cast('0x' || substr(md5('{config.seed}:' || cast(p.epochs as varchar) || ':' || coalesce(cast(r.doc_id as varchar), 'null')), 1, 13) as bigint) as draw
           from rows_ r join plan p on r.domain is not distinct from p.domain and r.lang is not distinct from p.lang
                                   and r.source is not distinct from p.source),
run as (select *, sum(n_tokens) over (partition by domain, lang, source order by draw, doc_id, n_tokens
                                      rows between unbounded preceding and current row) as upto from placed)
select doc_id, domain, lang, source, n_tokens, cast(epochs + case when upto <= rest then 1 else 0 end as integer) as copies
from run where epochs + case when upto <= rest then 1 else 0 end > 0
"""


def winnowing_sql(window: int = 10) -> str:
    """Every window of the items against every window of the documents."""
    words = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(_UPPER, _LOWER)
    return f"""
with b as (select item_id, {words} as w from benchmark),
bw as (select distinct item_id, list_slice(w, i, i + least({window}, len(w)) - 1) as win
       from (select item_id, w, unnest(range(1, greatest(len(w) - least({window}, len(w)), 0) + 2)) as i from b where len(w) > 0)),
sizes as (select distinct len(win) as k from bw),
d as (select row_number() over () as r, doc_id, {words} as w from documents),
dw as (select r, i, k, list_slice(w, i, i + k - 1) as win
       from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from d, sizes where len(w) >= k)),
hits as (select dw.r, dw.i, dw.k, bw.item_id from dw join bw on dw.win = bw.win),
places as (select r, count(distinct p) as n from (select r, unnest(range(i, i + k)) as p from (select distinct r, i, k from hits)) group by r),
lists as (select r, count(*) as n, string_agg(item, ',' order by item) as s
          from (select distinct r, cast(item_id as varchar) as item from hits where item_id is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(places.n, 0) as n_hit, coalesce(lists.n, 0) as n_items,
       sha256(coalesce(lists.s, '')) as items_sha256, places.n is not null as contaminated
from d left join places using (r) left join lists using (r)
"""


def phrases_sql(max_words: int = 5, min_count: int = 100, top: int = 2000) -> str:
    """Every n-gram counted as a list; every cut and every inner phrase looked up."""
    lower = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p),
total as (select lang, sum(len(w)) as n from w group by lang),
g as (select lang, list_slice(w, i, i + m - 1) as gram, m
      from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from w, range(1, {max_words + 1}) t(m) where len(w) >= m)),
f as (select lang, gram, m, count(*) as c from g group by lang, gram, m having count(*) >= {min_count}),
parts as (select lang, gram, m, c, i, j from f, range(1, {max_words + 1}) a(i), range(1, {max_words + 1}) b(j) where i <= j and j <= m),
inner_ as (select distinct lang, list_slice(gram, i, j) as gram, c from parts where j - i + 1 between 2 and m - 1),
kept as (select * from f where m > 1 and not exists (select 1 from inner_ q where q.lang = f.lang and q.gram = f.gram and q.c >= f.c)),
cuts as (select k.lang, k.gram, k.c as a, i as k, l.c as l, r.c as r
         from kept k, range(1, {max_words}) t(i), f l, f r
         where i < k.m and l.lang = k.lang and r.lang = k.lang and l.gram = list_slice(k.gram, 1, i) and r.gram = list_slice(k.gram, i + 1, k.m)),
scored as (select cuts.*, n, (1000::hugeint * a * n) // (l::hugeint * r) as score from cuts join total using (lang)),
best as (select * from scored qualify row_number() over (partition by lang, gram order by score, k) = 1),
ranked as (select *, array_to_string(gram, ' ') as phrase,
                  row_number() over (partition by lang order by score desc, a desc, array_to_string(gram, ' ')) as rank from best)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from ranked where rank <= {top}
"""


def _place_sql(name: str, tree: Node, seed: str) -> str:
    """CTEs ``name``_1, _2, _3: the child of each level with the smallest draw."""
    paths = [(r, k, s) for r in tree.children for k in r.children for s in k.children if r.weight > 0 and k.weight > 0 and s.weight > 0]
    values = ", ".join(f"({_text(r.name)}, {float(r.weight)}, {_text(k.name)}, {float(k.weight)}, {_text(s.name)}, {float(s.weight)}, {s.shard})"
                       for r, k, s in paths)
    hashed = "cast('0x' || substr(md5(concat_ws(':', '{seed}/' || t.{child}, cast(d.doc_id as varchar))), 1, 13) as bigint)"
    out = [f"{name}_t(region, region_weight, rack, rack_weight, leaf, leaf_weight, shard) as (values {values})"]
    above, held = "d", ""
    for i, (child, parents) in enumerate((("region", []), ("rack", ["region"]), ("leaf", ["region", "rack"])), 1):
        columns = [*parents, child, f"{child}_weight", *(["shard"] if child == "leaf" else [])]
        join = " and ".join(f"d.{p} = t.{p}" for p in parents) or "true"
        u = hashed.format(seed=seed, child=child)
        keep = ", ".join(f"t.{c}" for c in columns if c not in parents and not c.endswith("_weight"))
        out.append(f"""{name}_{i} as (
  select n, doc_id{held.replace(', ', ', d.')}, {keep} from (select n, doc_id{held} from {above}) d
  join (select distinct {', '.join(columns)} from {name}_t) t on {join}
  qualify row_number() over (partition by n order by -ln((cast({u} as double) + 0.5) / 4503599627370496.0) / t.{child}_weight) = 1)""")
        above, held = f"{name}_{i}", held + f", {child}"
    return ",\n".join(out)


def sharding_sql(n_shards: int = 40, seed: str = "place") -> str:
    """Every draw of every level of both trees, and plain row numbers per shard;
    the checksum bit by bit of its definition, from a table of 256 remainders."""
    table = ", ".join(str(_crc_remainder(i)) for i in range(256))
    return f"""
with b as (select row_number() over () as n, doc_id, coalesce(octet_length(encode(text)), 0) + {ROW_OVERHEAD_BYTES} as size,
                  list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: cast('0x' || x as bigint)) as bytes
           from documents),
d as (select n, doc_id, cast(size as bigint) as size,
             xor(list_reduce(list_prepend(4294967295::bigint, bytes),
                             lambda c, x: xor(c >> 8, ([{table}]::bigint[])[(xor(c, x) & 255) + 1])), 4294967295::bigint) as crc from b),
{_place_sql("p", default_tree(n_shards), seed)},
{_place_sql("g", default_tree(n_shards + 1), seed)}
select d.doc_id, d.size, d.crc as text_crc32, 'key' as law, cast(p.shard as integer) as shard,
       row_number() over (partition by p.shard order by
           cast('0x' || substr(md5(concat_ws(':', 'slot', cast(size as varchar), cast(crc as varchar), cast(d.doc_id as varchar))), 1, 13) as bigint),
           d.doc_id nulls first, size, crc) - 1 as slot,
       cast(g.shard as integer) as grown_shard, p.region, p.rack
from d join p_3 p using (n) join g_3 g using (n)
"""


def _crc_remainder(byte: int) -> int:
    """The CRC-32 register after one byte from an empty register."""
    return zlib.crc32(bytes([byte ^ 0xFF])) ^ 0xFFFFFFFF ^ 0x00FFFFFF
