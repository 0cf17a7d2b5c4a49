"""DuckDB SQL for the corpus queries that plain SQL can state."""

from __future__ import annotations

SPLIT = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN = rf"regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

HOST_RULES = rf"""
with docs as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text,
    {SPLIT} as w from documents),
windows as (select r, i, count(*) over (partition by r, g) as n from (
    select r, unnest(range(1, len(w) - 3)) as i,
      unnest(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) as g from docs where len(w) >= 5)),
repeats as (select r, sum(least(5, coalesce(next - i, 5)))::bigint as n_repeat_words from (
    select r, i, lead(i) over (partition by r order by i) as next from windows where n > 1) group by r),
lines as (select r, count(*) - count(distinct line) as n_dup_lines from (
    select r, unnest(string_split(text, chr(10))) as line from docs)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
counts as (select r, doc_id, source, len(w)::bigint as n_words,
    length(array_to_string(w, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from docs left join repeats using (r) left join lines using (r)),
judged as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counts),
hosts as (select source, count(*) as n, count(*) filter (where base_failed) as bad from judged group by source),
spread as (select sum(bad) / sum(n) as p, count(*) as hosts, sum(n) as docs, sum(bad * bad / n) as squares,
    sum(n::double * n) as sizes from hosts),
prior as (select p, (squares - docs * p * p - (hosts - 1) * p * (1 - p))
    / nullif(docs - sizes / docs, 0) as between_hosts from spread),
weighed as (select p, case when between_hosts > 0
    then greatest(p * (1 - p) / between_hosts - 1, 10.0) end as weight from prior),
verdicts as (select source, case when weight is null then p else (bad + weight * p) / (n + weight) end as rate
  from hosts, weighed)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and rate <= 0.5 as kept
from judged j join verdicts v on j.source is not distinct from v.source"""

JACCARD_JOIN = rf"""
with recursive docs as (select row_number() over () as r, doc_id,
    list_filter(string_split_regex(coalesce({LOWER}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
shingles as (select distinct r, unnest(case when len(w) between 1 and 3 then [w]
    else list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) end) as s from docs),
sizes as (select r, count(*) as n from shingles group by r),
pairs as (select a.r as a, b.r as b, count(*) as shared from shingles a join shingles b
  on a.s = b.s and a.r <> b.r group by all),
links as (select a, b from pairs join sizes x on x.r = a join sizes y on y.r = b
  where 100 * shared >= 85 * (x.n + y.n - shared)),
reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a, min(doc_id) as component from reach join docs on docs.r = b group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles,
  case when component < doc_id then component else doc_id end as component_id
from docs left join sizes using (r) left join least on least.a = docs.r"""

SYSTEMATIC_MIX = rf"""
with docs as (select doc_id, coalesce('a' || source, 'b') as k, len({SPLIT})::bigint as size from documents),
sources as (select k, sum(size)::hugeint as source_size,
    ([5, 2, 1])[(row_number() over (order by k) - 1) % 3 + 1]::hugeint as w from docs group by k),
running as (select *, sum(source_size) over () as total, sum(w) over () as weights,
    coalesce(sum(3 * source_size) over before, 0) as taken, coalesce(sum(w) over before, 0) as used
  from sources window before as (order by 3 * source_size / w::double, k
    rows between unbounded preceding and 1 preceding)),
closed as (select *, (total - taken) * w >= 3 * source_size * (weights - used) as capped from running),
level as (select total - coalesce((select sum(3 * source_size) from closed where capped), 0) as amount,
    (select sum(w) from closed where not capped) as share from closed limit 1),
targets as (select k, source_size::bigint as source_size,
    (case when capped then 3 * source_size else w * amount end)::hugeint as wanted,
    (case when capped then 1 else share end)::hugeint as parts from closed, level),
expected as (select *, case when source_size = 0 then 0
    else (wanted * 1000000000000::hugeint) // (parts * source_size) end as e,
    ('0x' || substr(md5('1/' || k), 1, 12))::bigint % 1000000000000 as u from targets),
placed as (select *, (row_number() over (partition by k
    order by length(size::varchar) * 100 + rpad(substr(size::varchar, 1, 2), 2, '0')::int,
      ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint % 256, size, doc_id) - 1)
    * e::hugeint + u as start from docs join expected using (k))
select doc_id, size, source_size, wanted::double / parts::double as target,
  (((start + e) // 1000000000000 - start // 1000000000000) * size)::bigint as taken
from placed"""

BENCHMARK_LEAKS = rf"""
with items as (select coalesce(item_id::varchar, '') as item, w, least(10, len(w)) as n from (
    select item_id, {PLAIN} as w from benchmark) where len(w) > 0),
windows as (select distinct item, n, unnest(list_transform(range(1, len(w) - n + 2),
    lambda i: w[i:i + n - 1])) as g from items),
docs as (select row_number() over () as r, doc_id, {PLAIN} as w from documents),
places as (select r, n, unnest(range(1, len(w) - n + 2)) as i,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])) as g
  from docs, (select distinct n from windows) where len(w) >= n),
hits as (select distinct r, i, n, item from places join windows using (n, g)),
words as (select r, count(distinct word) as n_hit from (
    select r, unnest(range(i, i + n)) as word from hits) group by r),
found as (select r, count(distinct item) as n_items,
    array_to_string(list_sort(list(distinct item)), ',') as items from hits group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (r) left join found using (r)"""

LEXICAL_SEARCH = rf"""
with docs as (select row_number() over () as r, doc_id, {PLAIN} as w from documents),
corpus as (select count(*) as n, sum(len(w))::bigint as l from docs where len(w) > 0),
counts as (select r, term, count(*) as tf from (select r, unnest(w) as term from docs) group by all),
held as (select term, count(*) as df from counts group by term),
queries as (select distinct item_id, unnest(w) as term from (
    select item_id, {PLAIN} as w from benchmark)),
weighed as (select item_id, term, floor(1000 * ln((2 * n + 2) / (2 * df + 1)))::bigint as weight
  from queries join held using (term), corpus),
factors as (select r, doc_id, 100 - 90 + (90 * len(w) * n) // l as m from docs, corpus where len(w) > 0),
scores as (select item_id, doc_id, r,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from weighed join counts using (term) join factors using (r) group by all),
ranked as (select item_id, doc_id, score, row_number() over (
    partition by item_id order by score desc, doc_id nulls first)::integer as rank
  from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10"""


def url_templates(levels: int = 8, support: int = 5, branching: int = 20, limit: float = 3.84,
                  weight: float = 10.0, most: float = 0.5) -> str:
    """One block of definitions per level of the tree."""
    ending = r"'\.(html|htm|php|asp|aspx|jsp|pdf|txt|xml|json)\z'"
    literal = "'=' || replace(replace(replace(segment, '{', '%7B'), '}', '%7D'), '|', '%7C')"
    stem = f"regexp_replace(segment, {ending}, '')"
    shape = rf"""(case when segment = '' then '' when regexp_matches({stem}, '^[0-9]+\z') then '{{n}}'
      when regexp_matches({stem}, '[0-9]') then '{{x}}' else '{{w}}' end)
      || regexp_extract(segment, {ending})"""

    def apart(a: str, n: str) -> str:
        a1, n1 = f"{a}::double", f"{n}::double"
        a2, n2 = f"lag({a}) over w::double", f"lag({n}) over w::double"
        gap, both = f"({a1} * {n2} - {a2} * {n1})", f"({a1} + {a2})"
        return (f"{gap} * {gap} * ({n1} + {n2}) > {limit}::double * {both} * ({n1} + {n2} - {both})"
                f" * {n1} * {n2}")

    def level(i: int) -> str:
        return f"""
here{i} as materialized (select *, segments[{i + 1}] as segment,
    case when len(segments) = {i + 1} then n else 0 end as ends from rows{i} where len(segments) > {i}),
children{i} as materialized (select *, case when n >= {support} and n * {branching} >= sum(n) over (
      partition by host, node) then {literal} else {shape} end as branch from (
    select host, node, segment, sum(n)::bigint as n, sum(labelled)::bigint as labelled,
      sum(bad)::bigint as bad, sum(ends)::bigint as ends, max(rate) as rate from here{i} group by all)),
branches{i} as (select host, node, branch, sum(n)::bigint as n, sum(labelled)::bigint as labelled,
    sum(bad)::bigint as bad, sum(ends)::bigint as ends, max(rate) as rate from children{i}
  group by host, node, branch),
ordered{i} as (select *, (bad + {weight}::double * rate) / (labelled + {weight}::double) as own from branches{i}),
compared{i} as (select *, coalesce({apart('bad', 'labelled')} or {apart('ends', 'n')}, false) as fresh
  from ordered{i} window w as (partition by host, node order by own, ends / n, branch)),
grouped{i} as (select *, sum(fresh::int) over (partition by host, node order by own, ends / n, branch) as g
  from compared{i}),
merged{i} as (select host, node, g, node || '/' || array_to_string(list_sort(list(branch)), '|') as to_node,
    (sum(bad) + {weight}::double * max(rate)) / (sum(labelled) + {weight}::double) as to_rate
  from grouped{i} group by host, node, g),
rows{i + 1} as materialized (select h.host, path, h.n, h.labelled, h.bad, segments, to_node as node, to_rate as rate
  from here{i} h join children{i} c using (host, node, segment)
    join grouped{i} b on b.host = h.host and b.node = h.node and b.branch = c.branch
    join merged{i} m on m.host = h.host and m.node = h.node and m.g = b.g),"""

    done = " union all ".join(f"select * from rows{i} where len(segments) = {i}"
                              for i in range(levels + 2))
    fits = {"example.com/de/": "block", "example.net/en/": "allow", "org/fr/": "allow", "net/": "block"}
    case = "case " + " ".join(
        f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '/{p}') then '{r}'"
        for r in fits for h, p in [r.split("/", 1)]) + " end"
    verdict = "case rule " + " ".join(f"when '{r}' then '{v}'" for r, v in fits.items())
    return rf"""
with raw as (select row_number() over () as r, page_id, case when instr(url, '://') > 0
    then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (select r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from raw),
marks as (select doc_id, max(greatest(1 - quality, toxic)) as bad from labels group by doc_id),
urls as (select p.*, bad from parts p left join marks on doc_id = page_id),
paths as materialized (select host, path, count(*) as n, count(bad) as labelled, coalesce(sum(bad), 0)::bigint as bad,
    string_split(path, '/')[2:] as s from urls group by host, path),
overall as (select coalesce(sum(bad) / sum(labelled), 0.0) as p from paths),
hosts as (select host, (sum(bad) + {weight}::double * any_value(p)) / (sum(labelled) + {weight}::double) as rate
  from paths, overall group by host),
rows0 as materialized (select paths.host, path, n, labelled, bad, case when len(s) > {levels + 1}
    then list_append(s[:{levels}], array_to_string(s[{levels + 1}:], '/')) else s end as segments,
    '' as node, rate from paths join hosts using (host)),
{"".join(map(level, range(levels + 1)))}
done as ({done}),
ruled as (select page_id, host, path, {case} as rule from parts)
select page_id, host, path, rule, {verdict}
  else case when rate > {most} then 'block' else 'allow' end end as verdict, node as template
from ruled join done using (host, path)"""


URL_TEMPLATES = url_templates()


def dialogue_repair() -> str:
    """Costs and audits of the four grammar states as nine digits and the edits so far, so
    that the least text is the cheapest and then the least audit."""
    states = range(1, 5)  # start, system, user, assistant
    after = {1: 3, 2: 3, 3: 4, 4: 3}
    allowed = {"s": {1: 2}, "u": {1: 3, 2: 3, 4: 3}, "a": {3: 4}}

    def plus(state: str, cost: str, edits: str) -> str:
        return f"lpad((substr({state}, 1, 9)::int + {cost})::varchar, 9, '0') || substr({state}, 10) || '{edits}'"

    def least(ways: list[str]) -> str:
        return f"least({', '.join(ways)}, null)"

    def inserted(list_name: str) -> str:
        """The four states, with up to two rows inserted."""
        ways = {s: [f"{list_name}[{s}]"] for s in states}
        for s in states:
            ways[after[s]].append(plus(f"{list_name}[{s}]", "5", "I"))
            ways[after[after[s]]].append(plus(f"{list_name}[{s}]", "10", "II"))
        return "[" + ", ".join(least(ways[s]) for s in states) + "]"

    def step() -> str:
        ways: dict[int, list[str]] = {s: [plus(f"q[{s}]", "2", "D")] for s in states}
        fault = "(case when row.cut then 5 else 0 end)"
        for s in states:
            ways[after[s]].append(f"case when not row.gone then {plus(f'q[{s}]', f'1 + {fault}', 'R')} end")
            for initial, moves in allowed.items():
                if s in moves:
                    ways[moves[s]].append(
                        f"case when not row.gone and row.c = '{initial}' then {plus(f'q[{s}]', fault, 'K')} end")
        return "[" + ", ".join(least(ways[s]) for s in states) + "]"

    return rf"""
with recursive keyed as (select *, row_number() over () as r, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
  from conversations),
crcs as (select k, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
    string_split(k, ''), lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295) % 20 as kind
  from (select distinct k from keyed)),
damaged as (select r, conv_id, turn, case when kind = 4 then 'user' else coalesce(role, ' ') end as role,
    case kind when 1 then '' when 2 then translate(coalesce(text, ' '), '.!?', '') else coalesce(text, ' ') end as text,
    unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from keyed join crcs using (k) where kind <> 0),
ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), r, copy) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first, r, copy) > 1 as seen,
    regexp_extract(text, '([^ 	-
])[ 	-
]*\z', 1) as tip from damaged),
faults as (select *, tip = '' as blank, tip <> '' and seen as dup,
    tip <> '' and not seen and tip not in ('.', '!', '?') as cut, tip = '' or seen as gone,
    substr(role, 1, 1) as c from ordered),
pairs as (select conv_id, lag(c) over (partition by conv_id order by i) || c as pair from faults),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (where blank) as blank, count(*) filter (where dup) as duplicate,
    count(*) filter (where cut) as truncated, max(i) as n,
    list(struct_pack(gone := gone, cut := cut, c := c) order by i) as word from faults group by conv_id),
illegal as (select conv_id, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
  from pairs group by conv_id),
steps as (select conv_id, word, 0 as pos, ['000000000', null, null, null]::varchar[] as p from counts
  union all select conv_id, word, pos + 1, {step()}
  from (select conv_id, word, pos, word[pos + 1] as row, {inserted('p')} as q from steps where pos < len(word))),
finished as (select conv_id, {least(["p[1]", plus("p[2]", "10", "II"), plus("p[3]", "5", "I"), "p[4]"])} as best
  from steps where pos = len(word)),
audits as (select conv_id, substr(best, 1, 9)::bigint as cost, substr(best, 10) as audit from finished),
signs as (select conv_id, unnest(string_split(audit, '')) as sign, generate_subscripts(string_split(audit, ''), 1) as pos
  from audits where audit <> ''),
placed as (select *, sum((sign <> 'I')::int) over w as i, sum((sign <> 'D')::int) over w as q
  from signs window w as (partition by conv_id order by pos rows unbounded preceding)),
lines as (select p.conv_id, pos, q, sign, f.role, f.text,
    max((q = 1 and sign = 'K' and f.c = 's')::int) over (partition by p.conv_id) as has_system
  from placed p left join faults f on f.conv_id is not distinct from p.conv_id and f.i = p.i and sign <> 'I'
  where sign <> 'D'),
repaired as (select conv_id, string_agg(case when sign = 'K' then role
      when (q + has_system) % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''),
    chr(10) order by pos) as body from lines group by conv_id),
every as (select distinct conv_id from conversations)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
  coalesce(audit, '') as audit, sha256(coalesce(body, '')) as repaired_sha256
from every e left join counts c on c.conv_id is not distinct from e.conv_id
  left join illegal i on i.conv_id is not distinct from e.conv_id
  left join audits a on a.conv_id is not distinct from e.conv_id
  left join repaired r on r.conv_id is not distinct from e.conv_id"""


DIALOGUE_REPAIR = dialogue_repair()
