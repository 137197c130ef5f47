"""What the queries should return, as SQL for an independent engine."""

from __future__ import annotations

#: Words of a text column, as an expression.
WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR = """
    words{n} as (select doc_id, {words} as ws from {source}),
    shingles{n} as (select distinct doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') as s
                 from words{n}, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as t(i) where len(ws) > 0),
    sizes{n} as (select doc_id, count(*) as n from shingles{n} group by 1),
    common{n} as (select a.doc_id as x, b.doc_id as y, count(*) as c from shingles{n} a join shingles{n} b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
    links{n} as (select x, y from common{n} join sizes{n} sx on sx.doc_id = x join sizes{n} sy on sy.doc_id = y where 100 * c >= 75 * (sx.n + sy.n - c)),
    ways{n} as (select x, y from links{n} union all select y, x from links{n}),
    reach{n} as (select x, y from ways{n} union select r.x, b.y from reach{n} r join ways{n} b on r.y = b.x),
    lowest{n} as (select x as doc_id, min(y) as low from reach{n} group by 1)"""


def near_parts(source: str, n: str = "") -> str:
    return _NEAR.format(source=source, n=n, words=WORDS.format(text=_LOWER))


NEAR_DUPLICATES = f"""with recursive {near_parts("documents")}
    select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) as component_id, d.doc_id <= coalesce(low, d.doc_id) as kept
    from documents d left join sizes using (doc_id) left join lowest using (doc_id)"""

_REPEATS = """
    split{n} as (select doc_id, {words} as ws from {source}),
    windows{n} as (select doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') as s from split{n}, unnest(range(1, len(ws) - 11)) as t(i)),
    firsts{n} as (select s, min(doc_id) as low from windows{n} group by 1 having min(doc_id) < max(doc_id)),
    gone{n} as (select distinct doc_id, k from windows{n} join firsts{n} using (s), unnest(range(i, i + 13)) as t(k) where low < doc_id),
    cut{n} as (select doc_id, len(ws) as n_words, coalesce(len(gs), 0) as n_removed,
        array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda k: gs is null or not list_contains(gs, k)), lambda k: ws[k]), ' ') as kept_text
        from split{n} left join (select doc_id, list(k) as gs from gone{n} group by 1) using (doc_id))"""


def repeat_parts(source: str, n: str = "") -> str:
    return _REPEATS.format(source=source, n=n, words=WORDS.format(text="coalesce(text, '')"))


SUBSTRING_DEDUP = f"""with {repeat_parts("documents")}
    select doc_id, n_words, n_removed, sha256(kept_text) as kept_sha256 from cut"""

_MIX = """
    sized{n} as (select {columns}, len({words}) as size,
        ('0x' || substr(md5('mix|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))), 1, 15))::bigint as place from {source}),
    wholes{n} as (select source, sum(size)::bigint as source_size, 2 * sum(size)::double as cap from sized{n} group by 1),
    ranked{n} as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight from wholes{n}),
    steps{n} as (select *, 1.5::double * sum(source_size) over () - coalesce(sum(cap) over w, 0) as rest, sum(weight) over () - coalesce(sum(weight) over w, 0) as others
        from ranked{n} window w as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
    capped{n} as (select *, rest * weight / others > cap as full_ from steps{n}),
    shares{n} as (select *, case when full_ then cap else (1.5::double * sum(source_size) over () - coalesce(sum(cap) filter (full_) over (), 0)) * weight
        / sum(weight) filter (not full_) over () end as target from capped{n}),
    ordered{n} as (select z.*, source_size, target, floor(target)::bigint as quota,
        coalesce(sum(size) over (partition by z.source order by place rows between unbounded preceding and 1 preceding), 0)::bigint as before
        from sized{n} z join shares{n} h on z.source is not distinct from h.source),
    mixed{n} as (select *, (case when source_size = 0 then 0 else quota // source_size * size + greatest(0, least(size, quota % source_size - before)) end)::bigint as taken from ordered{n})"""


def mix_parts(source: str, n: str = "", columns: str = "doc_id, source") -> str:
    return _MIX.format(source=source, n=n, columns=columns, words=WORDS.format(text="coalesce(text, '')"))


MIX = f"with {mix_parts('documents')} select doc_id, size, source_size, target, taken from mixed"

NEAR_VECTORS = """with recursive
    rows_ as (select vec_id, label, embedding::double[] as v from embeddings),
    usable as (select vec_id, label, v, sqrt(list_inner_product(v, v)) as norm from rows_
        where label is not null and v is not null and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0),
    links as (select a.vec_id as x, b.vec_id as y from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
        where list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
    reach as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x),
    lowest as (select x, min(y) as low from reach group by 1),
    counted as (select x, count(*) as n from links group by 1)
    select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id, vec_id <= coalesce(low, vec_id) as kept
    from rows_ left join counted on counted.x = vec_id left join lowest on lowest.x = vec_id"""

WARC = """with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n from pages),
    q as (select *, sha1(html) as digest, max(page_id) over (partition by html) as first from p)
    select page_id, n as payload_bytes, digest as payload_digest,
        case when n >= 1000 and page_id < first then 'revisit' else 'response' end as record_type,
        case when n >= 1000 and page_id < first then first end as refers_to from q"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text: a byte enters, then eight shifts (marked -1)."""
    return f"""xor(list_reduce(flatten([[4294967295::bigint], flatten(list_transform(string_split({text}, ''), lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))]),
        lambda c, x: case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c // 2, 3988292384::bigint) else c // 2 end), 4294967295::bigint)"""


#: Positions whose word comes again q places on, for every q; their stretches are the runs, and equal stretches keep the least q.
PERIODIC_RUNS = f"""with split as (select doc_id, {WORDS.format(text="coalesce(text, '')")} as ws, {crc32("doc_id::varchar")} as h from documents),
    tails as (select *, h // 10 as g, len(ws) as n, h // 10 % nullif(len(ws), 0) as a from split),
    periods as (select *, 1 + (n - a) // (3 + g % 8) as p from tails),
    damaged as (select doc_id, case when h % 10 = 0 and n > 0 then list_transform(range(0, n), lambda i: case when i < a then ws[i + 1] else ws[a + (i - a) % p + 1] end) else ws end as ws
        from periods),
    words as (select doc_id, len(ws) as n, unnest(ws) as w, generate_subscripts(ws, 1) - 1 as i from damaged),
    same as (select x.doc_id, x.i, y.i - x.i as q from words x join words y on x.doc_id = y.doc_id and x.w = y.w and y.i > x.i and 4 * (y.i - x.i) <= x.n),
    islands as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as k from same),
    stretches as (select doc_id, q, min(i) as start, count(*) + q as length from islands group by doc_id, q, k having count(*) + q >= greatest(6, 4 * q)),
    runs as (select doc_id, start, length, min(q) as period from stretches group by 1, 2, 3),
    ranked as (select *, row_number() over (partition by doc_id order by length::hugeint * 1000000000000 // period desc, start, period) as rank from runs),
    told as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from runs group by 1),
    gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
    dropped as (select doc_id, list(i) as gs from gone group by 1)
    select d.doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
        sha256(array_to_string(case when gs is null then d.ws else list_transform(list_filter(range(0, len(d.ws)), lambda k: not list_contains(gs, k)), lambda k: d.ws[k + 1]) end, ' ')) as collapsed_sha256
    from damaged d left join told using (doc_id) left join (select * from ranked where rank = 1) using (doc_id) left join dropped using (doc_id)"""


def _turn_state(s: int) -> str:
    """Cheapest edits of a turn and all after it from one state: cost, letters, lines. Fields c, a, l compare in that order."""
    after = (2, 2, 3, 2)[s]
    wanted, role = ("u", "user") if after == 2 else ("a", "assistant")
    line = lambda role: f"{role} || ':' || t.text || case when {{to}}.l = '' then '' else chr(10) || {{to}}.l end"
    keep = lambda to, when: f"case when not gone and {when} then {{{{'c': {to}.c + charge, 'a': 'K' || {to}.a, 'l': {line('t.role').format(to=to)}}}}} end"
    ways = [f"{{'c': p.s{s}.c + 2, 'a': 'D' || p.s{s}.a, 'l': p.s{s}.l}}", keep(f"p.s{after}", f"initial = '{wanted}'").replace("{{", "{").replace("}}", "}")]
    ways.append(f"case when not gone and initial <> '{wanted}' then {{'c': p.s{after}.c + 1 + charge, 'a': 'R' || p.s{after}.a, 'l': {line(chr(39) + role + chr(39)).format(to=f'p.s{after}')}}} end")
    if s == 0:
        ways.append(keep("p.s1", "initial = 's'").replace("{{", "{").replace("}}", "}"))
    return f"list_min(list_filter([{', '.join(ways)}], lambda x: x is not null)) as b{s}"


def _put_in(s: int, of: str = "b") -> str:
    after = (2, 2, 3, 2)[s]
    role = "user" if after == 2 else "assistant"
    return f"""list_min([{of}{s}, {{'c': {of}{after}.c + 5, 'a': 'I' || {of}{after}.a, 'l': '{role}:' || case when {of}{after}.l = '' then '' else chr(10) || {of}{after}.l end}}])"""


#: From the last turn back to the first, the cheapest edits from each of four states; ties go to the least letters.
TURN_REPAIR = f"""with recursive
    told as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as f from conversations),
    damaged as (select conv_id, turn, case when f = 4 then 'user' else role end as role,
        case f when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(0, case when f = 3 then 2 else 1 end)) as copy from told where f <> 0),
    placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n from damaged),
    marked as (select *, substr(role, 1, 1) as initial, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, row_number() over (partition by conv_id, role, text order by n) > 1 as again,
        not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as open_, substr(lag(role) over (partition by conv_id order by n), 1, 1) as before from placed),
    turns as (select *, blank or again as gone, case when open_ then 5 else 0 end as charge, count(*) over (partition by conv_id) as size from marked),
    steps as (
        select conv_id, size + 1 as n, {{'c': 0, 'a': '', 'l': ''}} as s0, {{'c': 10, 'a': 'II', 'l': 'user:' || chr(10) || 'assistant:'}} as s1, {{'c': 5, 'a': 'I', 'l': 'assistant:'}} as s2,
            {{'c': 0, 'a': '', 'l': ''}} as s3 from (select distinct conv_id, size from turns)
        union all
        select conv_id, n, {', '.join(_put_in(s, "d") for s in range(4))} from (
            select conv_id, n, {', '.join(f"{_put_in(s)} as d{s}" for s in range(4))} from (
                select t.conv_id, t.n, {', '.join(_turn_state(s) for s in range(4))} from steps p join turns t on t.conv_id is not distinct from p.conv_id and t.n = p.n - 1))),
    counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (not blank and again) as duplicate,
        count(*) filter (not gone and open_) as truncated, count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal from turns group by 1)
    select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
        coalesce(s0.c, 0)::bigint as cost, coalesce(s0.a, '') as audit, sha256(coalesce(s0.l, '')) as repaired_sha256
    from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id left join (select * from steps where n = 1) s on s.conv_id is not distinct from o.conv_id"""
