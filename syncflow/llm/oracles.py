"""SQL of the operators that SQL can express."""

from __future__ import annotations

ORACLES = {
    "op2_quote_links": """
        with recursive m as (
            select conv_id, turn, coalesce(text, '') as text,
                   trim(lower(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) as words
            from conversations),
        said as (select conv_id, turn, min(words) as words from m
                 where conv_id is not null and turn is not null group by conv_id, turn),
        original as (
            select words, min({'conv_id': conv_id, 'turn': turn}) as first
            from said where words <> '' group by words),
        quote as (
            select m.conv_id, m.turn, m.text, 1 as level, b.words from m
            left join said b on b.conv_id = m.conv_id and b.turn = m.turn - 1
            union all
            select m.conv_id, m.turn, m.text, 2, b.words from m
            left join said b on b.conv_id = m.conv_id and b.turn = m.turn - 2),
        near as (
            select q.conv_id, q.turn, q.level, max(s.turn) as turn_before
            from (select distinct conv_id, turn, level, words from quote) q
            join said s on s.conv_id = q.conv_id and s.turn < q.turn and s.words = q.words
            where q.words <> '' group by q.conv_id, q.turn, q.level),
        found as (
            select q.*, case when n.turn_before is not null
                             then {'conv_id': q.conv_id, 'turn': n.turn_before}
                             when o.first < {'conv_id': q.conv_id, 'turn': q.turn}
                             then o.first end as f
            from quote q left join original o on o.words = q.words
                 left join near n on n.conv_id = q.conv_id and n.turn = q.turn
                                     and n.level = q.level),
        linked as (
            select a.conv_id, a.turn, a.text, a.words as w1, b.words as w2, a.f as f1, b.f as f2
            from found a join found b
              on a.conv_id = b.conv_id and a.turn = b.turn and a.level = 1 and b.level = 2),
        thread as (
            select conv_id, turn, coalesce(f1, f2) as up,
                   {'conv_id': conv_id, 'turn': turn} as root, 0::bigint as depth
            from linked where coalesce(f1, f2) is null
            union all
            select l.conv_id, l.turn, coalesce(l.f1, l.f2), t.root, t.depth + 1
            from linked l join thread t
              on coalesce(l.f1, l.f2) = {'conv_id': t.conv_id, 'turn': t.turn})
        select l.conv_id, l.turn, t.up.conv_id as parent_conv_id, t.up.turn as parent_turn,
               t.root.conv_id as root_conv_id, t.root.turn as root_turn, t.depth,
               (coalesce(l.w1 <> '', false)::int + coalesce(l.w2 <> '', false)::int)::bigint
                   as n_quoted,
               ((l.f1 is not null)::int + (l.f2 is not null)::int)::bigint as n_linked,
               sha256(l.text) as own_sha256
        from linked l join thread t on t.conv_id = l.conv_id and t.turn = l.turn""",
    "op3_pivot_search": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding,
                      lambda x: x is null or not isfinite(x::double))) = 0),
        scored as (
            select q.vec_id as query_id, c.vec_id as vec_id,
                   coalesce(list_inner_product(q.v, c.v), 0)::bigint as score
            from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
            where q.vec_id % 50 = 0),
        ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int
                as rank
            from scored)
        select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op7_source_schedule": """
        with d as (
            select row_number() over () as r, doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
                   md5(coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))) as place
            from documents),
        s0 as (select source, sum(size)::bigint as source_size from d group by source),
        s1 as (
            select *, [3, 1, 2][((row_number() over o - 1) % 3 + 1)::int]::bigint as weight,
                   row_number() over o - 1 as no
            from s0 window o as (order by source nulls last)),
        s2 as (
            select *, (sum(source_size) over ())::bigint as all_size, 2 * source_size as lim,
                   coalesce(sum(2 * source_size) over (o rows between unbounded preceding
                       and 1 preceding), 0)::bigint as full_before,
                   (sum(weight) over (o rows between current row and unbounded following))::bigint
                       as weight_left
            from s1 window o as (order by 2 * source_size / weight::double, no)),
        s3 as (select *, lim * weight_left <= (all_size * 1.5::double - full_before) * weight as capped
               from s2),
        s4 as (select *, coalesce(sum(case when capped then lim end) over (), 0)::bigint as full_size,
                      (sum(case when not capped then weight end) over ())::bigint as weight_rest
               from s3),
        s5 as (
            select *, case when capped then lim::double
                      else (all_size * 1.5::double - full_size) * weight / weight_rest end as target,
                   coalesce(sum(case when capped then lim end) over w, 0)::double as int_to,
                   coalesce(sum(case when not capped then weight end) over w, 0)::bigint as w_to
            from s4 window w as (order by no rows between unbounded preceding and current row)),
        s6 as (
            select *, int_to + coalesce((all_size * 1.5::double - full_size) * w_to / weight_rest, 0)
                       as target_to,
                   (int_to - case when capped then lim else 0 end)
                       + coalesce((all_size * 1.5::double - full_size)
                           * (w_to - case when capped then 0 else weight end) / weight_rest, 0)
                       as target_from
            from s5),
        s7 as (
            select *, max(target_to) over () as total,
                   power(2, ceil(log2(greatest((max(target_to) over ()) / 128.0::double,
                       least(max(target_to) over (), 65536.0::double), 1.0)))) as slots
            from s6),
        s8 as (
            select source, no, source_size, target,
                   floor(greatest(least(ceil(slots * target_to / total), slots)
                       - ceil(slots * target_from / total), 0) * (total / slots))::bigint as reach
            from s7),
        p as (
            select d.r, d.doc_id, d.size, s.source_size, s.target, s.reach,
                   (sum(d.size) over (partition by s.no order by d.place, d.size, d.doc_id, d.r))::bigint
                       - d.size as start
            from d join s8 s on d.source is not distinct from s.source)
        select doc_id, size, source_size, target,
               (greatest(0, least(start + size, reach) - start)
                + greatest(0, least(source_size + start + size, reach) - source_size - start))::bigint
                   as taken
        from p""",
    "op9_warc_segments": """
        with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
        g as (select payload, max(page_id) as first_id from p group by payload)
        select p.page_id, octet_length(p.payload)::bigint as payload_bytes, 
               list_aggregate(list_transform(range(32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(sha1(p.payload), 5 * (i // 4) + 1, 5))::bigint
                         >> (15 - 5 * (i % 4))) & 31)::int, 1)), 'string_agg', '')
                   as payload_digest,
               case when p.page_id is not distinct from g.first_id or g.first_id is null
                    then 'response' else 'revisit' end as record_type,
               case when p.page_id is distinct from g.first_id then g.first_id end as refers_to
        from p join g on p.payload = g.payload""",
    "op10_line_runs": """
        with lines as (
            select rowid as r, doc_id, u.i as i, u.line as line,
                   translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from (select row_number() over () as rowid, doc_id,
                         string_split(coalesce(text, ''), chr(10)) as a from documents) d,
                 lateral (select unnest(a) as line, generate_subscripts(a, 1) as i) u),
        common as (
            select key, max(doc_id) as last_doc from lines
            where length(key) >= 40 group by key
            having count(distinct r) >= 5 and max(doc_id) is not null),
        marked as (
            select l.*, c.key is not null and l.doc_id is distinct from c.last_doc as gone
            from lines l left join common c on l.key = c.key)
        select doc_id, count(*)::bigint as n_lines,
               (count(*) filter (where gone))::bigint as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), ''))
                   as kept_sha256
        from marked group by r, doc_id""",
    "op12_prefix_trie": """
        with t as (
            select conv_id as c, row_number() over (partition by conv_id
                       order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p,
                   {'role': coalesce(role, ''), 'text': coalesce(text, '')} as m
            from conversations where conv_id is not null),
        lens as (select c, count(*) as n from t group by c),
        heads as (
            select c, n, c - c % 5 as base, xor(list_reduce(list_prepend(4294967295::bigint,
                       list_transform(range(length(c::varchar)),
                                      lambda i: ascii(substr(c::varchar, i + 1, 1))::bigint)),
                       lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 9 as h
            from lens),
        turns as (
            select i.c, t.p, t.m from heads i join t on t.c = i.base where t.p <= i.h
            union all
            select i.c, coalesce(least(i.h, b.n), 0) + t.p - i.h, t.m
            from heads i join t on t.c = i.c left join lens b on b.c = i.base where t.p > i.h),
        conv as (
            select i.c, coalesce(list(u.m order by u.p) filter (where u.p is not null), []) as ms
            from heads i left join turns u on u.c = i.c group by i.c),
        member as (
            select c, len(ms) as n, u.d as d, ms[1:u.d] as path
            from conv, lateral (select unnest(range(len(ms) + 1)) as d) u),
        node as (
            select path, d, min(c) as conv_id, count(*) as n_convs,
                   coalesce(string_agg(c::varchar, ',' order by c) filter (where n = d), '') as ends
            from member group by path, d),
        child as (select path[1:d - 1] as path, d - 1 as d, count(*) as n from node
                  where d > 0 group by 1, 2),
        marked as (
            select node.*, coalesce(child.n, 0) as n_children,
                   case when node.d > 0 then (n_convs - 1) * strlen(node.path[node.d].text) else 0 end
                       as saved
            from node left join child on child.path = node.path and child.d = node.d),
        below as (
            select path[1:u.k] as path, u.k as d, count(*) filter (where n_children = 0) as n_leaves,
                   sum(saved) as saved_tokens
            from marked, lateral (select unnest(range(d + 1)) as k) u group by 1, 2)
        select m.conv_id, m.d::bigint as depth, up.conv_id as parent_conv_id,
               m.n_convs::bigint as n_convs, m.n_children::bigint as n_children,
               b.n_leaves::bigint as n_leaves, b.saved_tokens::bigint as saved_tokens,
               sha256(m.ends) as ends_sha256
        from marked m join below b on b.path = m.path and b.d = m.d
             left join node up on m.d > 0 and up.d = m.d - 1 and up.path = m.path[1:m.d - 1]""",
    "op13_fm_index": """
        with d as (
            select row_number() over () as r, doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
            from documents),
        i as (
            select item_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
            from benchmark),
        win as (
            select distinct item_id, least(len(w), 10) as size,
                   array_to_string(w[u.k:u.k + least(len(w), 10) - 1], ' ') as phrase
            from i, lateral (select unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k) u
            where len(w) > 0),
        sizes as (select distinct size from win),
        dw as (
            select r, size, u.k as k, array_to_string(w[u.k:u.k + size - 1], ' ') as phrase
            from d, sizes, lateral (select unnest(range(1, len(w) - size + 2)) as k) u),
        hit as (select distinct r, k, size, item_id from dw join win using (size, phrase)),
        words as (
            select r, count(distinct u.p) as n_hit
            from hit, lateral (select unnest(range(k, k + size)) as p) u group by r),
        told as (
            select r, count(distinct item_id) as n_items,
                   string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
            from hit group by r)
        select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
               coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from d left join words using (r) left join told using (r)""",
}
