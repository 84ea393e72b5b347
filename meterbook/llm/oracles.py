"""SQL of the operators that SQL can express, over whole tables."""

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
        with plain as (
          select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
        select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
          doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from plain""",
    "op3_line_dedup": f"""
        with lines as (
          select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
          from documents),
        keyed as (
          select *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from lines),
        repeated as (
          select key, max(doc_id) as last from keyed where length(key) >= 40
          group by key having count(distinct doc_id) >= 5),
        judged as (
          select k.*, r.key is not null and k.doc_id < r.last as gone from keyed k left join repeated r on k.key = r.key)
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
          sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
        from judged group by doc_id""",
    "op4_mixing": rf"""
        with quality as (
          select doc_id, pow(4.0, avg(quality::double) - 0.5) as w from labels where doc_id is not null group by doc_id),
        sized as (
          select d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '{_WORD}')) as size,
            case when q.w > 0 then q.w else 1.0 end as w
          from documents d left join quality q on d.doc_id = q.doc_id),
        totals as (select source, sum(size)::bigint as source_size from sized group by source),
        ranked as (
          select *, 2.0::double * source_size as cap,
            [3.0::double, 1.0::double, 2.0::double][1 + (row_number() over (order by source is null, source) - 1) % 3] as weight
          from totals),
        steps as (
          select *, cap / weight as turn,
            coalesce(sum(cap) over (order by cap / weight, source rows between unbounded preceding and 1 preceding), 0) as fixed,
            sum(weight) over (order by cap / weight, source rows between current row and unbounded following) as open
          from ranked),
        level as (
          select arg_min((all_words - fixed) / open, fixed) as l
          from steps, (select 1.5::double * sum(source_size) as all_words from totals)
          where (all_words - fixed) / open <= turn),
        targets as (
          select source, source_size, least(l * weight, cap) as target,
            case when source_size > 0 then floor(least(l * weight, cap) / source_size) else 0 end as epochs
          from ranked, level),
        keyed as (
          select s.*, t.source_size, t.target, t.epochs, t.target - t.epochs * t.source_size as rest,
            -ln((('0x' || substr(md5('7:' || s.doc_id), 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double) / s.w as key
          from sized s join targets t on s.source is not distinct from t.source),
        placed as (
          select *, sum(size) over (partition by source order by key, doc_id, size
            rows between unbounded preceding and current row) as upto
          from keyed)
        select doc_id, size::bigint as size, source_size, target,
          (size * (epochs + case when rest > 0 and 2 * upto - size <= 2 * rest then 1 else 0 end))::bigint as taken
        from placed""",
    "op8_exact_topk": """
        with whole as (
          select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
          where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
          select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
          from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
        ranked as (
          select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
        select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op9_url_filter": rf"""
        with split as (
          select page_id, coalesce({_LOWER.format("regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 2, 's')")}, '') as host,
            coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 3, 's'), '') as path
          from pages),
        judged as (
          select *, '.' || host as h,
            case
              when suffix('.' || host, '.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
              when suffix('.' || host, '.example.com') and starts_with(path, '/en/') then 'example.com/en/'
              when suffix('.' || host, '.net') and starts_with(path, '/es/') then 'net/es/'
              when suffix('.' || host, '.net') and starts_with(path, '/fr/') then 'net/fr/'
              when suffix('.' || host, '.com') and starts_with(path, '/') then 'com/'
            end as rule
          from split)
        select page_id, host, path, rule,
          case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict
        from judged""",
    "op11_phrase_mining": rf"""
        with cut as (
          select coalesce(lang, 'und') as lang,
            unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece
          from documents),
        listed as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from cut),
        placed as (select lang, w, unnest(range(1, len(w) + 1)) as i from listed where len(w) > 0),
        words as (select lang, w[i] as a, w[i + 1] as b, w[i + 2] as c from placed),
        sizes as (select lang, count(*) as n from words group by lang),
        found as (
          select lang, 1 as size, a, null as b, null as c, a as phrase, count(*) as f from words group by lang, a
          union all
          select lang, 2, a, b, null, a || ' ' || b, count(*) from words where b is not null group by lang, a, b
          union all
          select lang, 3, a, b, c, a || ' ' || b || ' ' || c, count(*) from words where c is not null group by lang, a, b, c),
        often as (select * from found where f >= 10),
        longer as (
          select lang, phrase, max(f) as longest from (
            select lang, a || ' ' || b as phrase, f from often where size = 3
            union all select lang, b || ' ' || c, f from often where size = 3) group by lang, phrase),
        cuts as (
          select lang, phrase, f, 1 as k, a as p, b as q from often where size = 2
          union all select lang, phrase, f, 1, a, b || ' ' || c from often where size = 3
          union all select lang, phrase, f, 2, a || ' ' || b, c from often where size = 3),
        scored as (
          select t.lang, t.phrase, t.f as a, t.k, x.f as l, y.f as r,
            ((1000000::hugeint * t.f * t.f) // (x.f::hugeint * y.f))::bigint as score
          from cuts t join often x on x.lang = t.lang and x.phrase = t.p join often y on y.lang = t.lang and y.phrase = t.q),
        best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        kept as (
          select s.* from best s left join longer o on o.lang = s.lang and o.phrase = s.phrase
          where o.longest is null or 100 * o.longest < 50 * s.a)
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
          phrase, a, l, r, n, score
        from kept join sizes using (lang) qualify rank <= 2000""",
    "op13_conversation_repair": rf"""
        with recursive keyed as (
          select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
            coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
        coded as (
          select *, xor(list_reduce([4294967295] || list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))),
            lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
              lambda x, step: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 as code
          from keyed),
        damaged as (
          select conv_id, turn, case when code = 4 then 'user' else role end as role,
            case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
            unnest(case when code = 3 then [1, 2] else [1] end) as copy
          from coded where code <> 0),
        ordered as (
          select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i from damaged),
        seen as (
          select *, i > min(i) over (partition by conv_id, role, text) as again,
            regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last,
            substr(role, 1, 1) as initial, substr(lead(role) over (partition by conv_id order by i), 1, 1) as following,
            lead(role) over (partition by conv_id order by i) is not null as followed
          from ordered),
        judged as (
          select *, case when last = '' then 'blank' when again then 'duplicate'
            when last not in ('.', '!', '?') then 'truncated' else 'none' end as fault from seen),
        counts as (
          select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
            count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
            count(*) filter (where fault = 'truncated') as truncated,
            count(*) filter (where followed and initial || following not in ('su', 'ua', 'au')) as illegal,
            list([initial, fault, role, text] order by i) as rows
          from judged group by conv_id),
        -- least cost and edits so far in each state: start, s, u, a; two inserts at most before a row
        walk as (
          select conv_id, rows, 0 as i, {{'c': 0, 'e': ''}} as p0, {{'c': 9000000000, 'e': ''}} as ps,
            {{'c': 9000000000, 'e': ''}} as pu, {{'c': 9000000000, 'e': ''}} as pa
          from counts
          union all
          select conv_id, rows, i + 1,
            {{'c': q0.c + 4, 'e': q0.e || 'D'}},
            least({{'c': qs.c + 4, 'e': qs.e || 'D'}},
              {{'c': case when stays and first = 's' then q0.c + extra else 9000000000 end, 'e': q0.e || 'K'}}),
            least({{'c': qu.c + 4, 'e': qu.e || 'D'}},
              {{'c': case when stays and first = 'u' then before_u.c + extra else 9000000000 end, 'e': before_u.e || 'K'}},
              {{'c': case when stays then before_u.c + 3 + extra else 9000000000 end, 'e': before_u.e || 'R'}}),
            least({{'c': qa.c + 4, 'e': qa.e || 'D'}},
              {{'c': case when stays and first = 'a' then qu.c + extra else 9000000000 end, 'e': qu.e || 'K'}},
              {{'c': case when stays then qu.c + 3 + extra else 9000000000 end, 'e': qu.e || 'R'}})
          from (
            select *, least(q0, qs, qa) as before_u from (
              select conv_id, rows, i, rows[i + 1][1] as first, rows[i + 1][2] not in ('blank', 'duplicate') as stays,
                case when rows[i + 1][2] = 'truncated' then 3 else 0 end as extra, p0 as q0, ps as qs,
                least(pu, {{'c': p0.c + 3, 'e': p0.e || 'I'}}, {{'c': ps.c + 3, 'e': ps.e || 'I'}},
                  {{'c': pa.c + 3, 'e': pa.e || 'I'}}) as qu,
                least(pa, {{'c': pu.c + 3, 'e': pu.e || 'I'}}, {{'c': p0.c + 6, 'e': p0.e || 'II'}},
                  {{'c': ps.c + 6, 'e': ps.e || 'II'}}) as qa
              from walk where i < len(rows)))),
        ended as (
          select conv_id, rows, least(p0, pa, {{'c': pu.c + 3, 'e': pu.e || 'I'}}, {{'c': ps.c + 6, 'e': ps.e || 'II'}}) as best
          from walk where i = len(rows)),
        letters as (
          select conv_id, rows, unnest(range(1, length(best.e) + 1)) as j, best.e as e from ended),
        taken as (
          select conv_id, j, substr(e, j, 1) as edit, rows[length(replace(substr(e, 1, j), 'I', ''))] as row from letters),
        staying as (
          select *, row_number() over (partition by conv_id order by j) as nth,
            first_value(edit = 'K' and row[1] = 's') over (partition by conv_id order by j) as has_s
          from taken where edit <> 'D'),
        texts as (
          select conv_id, sha256(string_agg(case edit when 'K' then row[3]
              else case when (nth + has_s::int) % 2 = 1 then 'user' else 'assistant' end end
              || ':' || case edit when 'I' then '' else row[4] end, chr(10) order by j)) as repaired_sha256
          from staying group by conv_id)
        select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
          coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.c, 0)::bigint as cost,
          coalesce(best.e, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
        from (select distinct conv_id from conversations) o
          left join counts c on c.conv_id is not distinct from o.conv_id
          left join ended d on d.conv_id is not distinct from o.conv_id
          left join texts t on t.conv_id is not distinct from o.conv_id""",
}
