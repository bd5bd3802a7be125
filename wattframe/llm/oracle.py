"""SQL for an independent engine that gives the queries' rows, where SQL can say it."""

from __future__ import annotations

from wattframe.llm import chat, clusters, licenses, repetition, secrets

#: op5: the same template and escapes, read straight from the turns.
_FOUND = "|".join("".join(f"\\{x}" if not x.isalnum() else x for x in c) for c in sorted(chat.CONTROL, key=len, reverse=True))


def _escaped(c: str) -> str:
    # Each control string grows by one character, each backslash by one.
    return f"(length({c}) + length({c}) - length(replace({c}, chr(92), '')) + len(regexp_extract_all({c}, '{_FOUND}')))"


OP5 = f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
 coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
 sum(length('<s>[ROLE][/ROLE]</s>') + {_escaped("role")} + {_escaped("text")})::bigint as formatted_chars from t group by 1"""

_WORDS6 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP6 = f"""
with b as (select item_id, {_WORDS6} as w from benchmark where item_id is not null), d as (select doc_id, {_WORDS6} as w from documents),
p as (select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as gram from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from b where len(w) > 0)),
g as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from p) where len(w) >= n)),
h as (select doc_id, item_id, i, g.n from g join p on g.n = p.n and g.gram = p.gram),
c as (select doc_id, count(distinct k)::bigint as n_hit from (select doc_id, unnest(range(i, i + n)) as k from h) group by 1),
m as (select doc_id, count(*)::bigint as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct doc_id, item_id::varchar as item_id from h) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated from d left join c using (doc_id) left join m using (doc_id)"""

OP7 = """
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*)::bigint as n from s group by 1),
e as (select a.doc_id as u, b.doc_id as v from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2 having 100 * count(*) >= 75 * ((select n from n where doc_id = a.doc_id) + (select n from n where doc_id = b.doc_id) - count(*))),
b as (select u, v from e union select v, u from e),
r as (select u as id, u as seen from b union select r.id, b.v from r join b on b.u = r.seen),
c as (select id, min(seen) as low from r group by 1)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) as kept from d left join n on n.doc_id = d.doc_id left join c on c.id = d.doc_id"""


def _templates() -> str:
    rows = []
    for n, (name, text) in enumerate(licenses.TEMPLATES):
        words = licenses.template_words(text)
        grams = sorted({" ".join(words[i : i + licenses.SHINGLE]) for i in range(max(1, len(words) - licenses.SHINGLE + 1))})
        width = next((w for w in licenses.WIDTHS if 2 * len(grams) <= w), 4 * len(grams))
        rows += [f"('{name}', {n}, {width}, {len(grams)}, '{g}')" for g in grams]
    return ", ".join(rows)


OP3 = f"""
with t(license, template, width, size, gram) as (values {_templates()}),
d as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') as w from documents),
g as (select doc_id, i, array_to_string(w[i + 1:i + 5], ' ') as gram from (select doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) as i from d)),
h as (select doc_id, license, template, width, size, g.gram, unnest(range(greatest(0, ceil((i - width + 1) / (width / 2))::bigint), (i // (width // 2)) + 1)) * (width // 2) as start from g join t on t.gram = g.gram),
f as (select doc_id, license, min(start) as word from (select doc_id, license, template, start from h group by 1, 2, 3, 4 having count(distinct gram) >= 0.75 * any_value(size)) group by 1, 2),
m as (select doc_id, count(*)::bigint as n, string_agg(license, ',' order by license) as names, min(word)::bigint as word from f group by 1)
select doc_id, coalesce(n, 0) as n_licenses, coalesce(names, '') as licenses, coalesce(word, -1) as first_word from d left join m using (doc_id)"""


def _base(kind: int, pattern: str, extra: str = "") -> str:
    p = pattern.replace("'", "''")
    return f"""k{kind} as (select doc_id, {kind} as k, unnest(m) as m, unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)))::bigint as s{extra}
 from (select doc_id, regexp_extract_all(text, '{p}') as m, string_split_regex(text, '{p}') as p{", regexp_extract_all(text, '" + p + "', 2) as v" if extra else ""} from d) where len(m) > 0)"""


def _entropy(kind: int, name: str) -> str:
    pattern, _, least = secrets.CLASSES[name]
    w = secrets.WINDOW
    allowed = secrets.ALLOWED.split("|(?i)")
    keep = f"not regexp_matches(m, '{allowed[0]}') and not regexp_matches(m, '{allowed[1]}', 'i')"
    return f"""{_base(kind, pattern)},
w{kind} as (select doc_id, s, i from (select doc_id, s, m, unnest(range(0, length(m) - {w - 1})) as i from k{kind} where {keep}) where list_aggregate(string_split(substr(m, i + 1, {w}), ''), 'entropy') >= {least} - 1e-9),
i{kind} as (select doc_id, s, i, sum(fresh) over (partition by doc_id, s order by i) as run from (select *, case when i - lag(i) over (partition by doc_id, s order by i) <= {w} then 0 else 1 end as fresh from w{kind})),
e{kind} as (select doc_id, {kind} as k, s + min(i) as s, s + max(i) + {w} as e from i{kind} group by doc_id, s, run)"""


_KINDS = "['" + "', '".join(secrets.KINDS) + "']"
OP2 = f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
{_base(0, secrets.ASSIGN, ", unnest(v) as v")}, {_base(1, secrets.ACCESS)}, {_base(2, secrets.HEX)}, {_entropy(3, "entropy_hex")}, {_entropy(4, "entropy_base64")},
a as (select doc_id, k, s, s + length(m) as e from k0 where length(v) >= {secrets.ASSIGN_LEAST} union all select doc_id, k, s, s + length(m) from k1 union all select doc_id, k, s, s + length(m) from k2 union all select doc_id, k, s, e from e3 union all select doc_id, k, s, e from e4),
g as (select doc_id, count_if(k = 0)::bigint as n0, count_if(k = 1)::bigint as n1, count_if(k = 2)::bigint as n2, string_agg({_KINDS}[k + 1] || ':' || s || ':' || e, ',' order by s, k, e) filter (k < 3) as base, string_agg({_KINDS}[k + 1] || ':' || s || ':' || e, ',' order by s, k, e) as spans from a group by 1)
select doc_id, coalesce(n0, 0) as n_assign, coalesce(n1, 0) as n_access, coalesce(n2, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join g using (doc_id)"""

_WHOLE = "embedding is not null and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: not isfinite(x))) = 0"

#: op11: every anchor's scores with every row, without codes or bounds.
OP11 = f"""
with w as (select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings where vec_id is not null and label is not null and len(embedding) > 0 and {_WHOLE}),
v as (select vec_id, min(struct_pack(label := label, v := v)) as x from w group by 1),
s as (select a.vec_id as a, b.vec_id as b, a.x.label = b.x.label as same, list_inner_product(a.x.v, b.x.v)::bigint as score from v a join v b on a.vec_id <> b.vec_id and len(a.x.v) = len(b.x.v) where a.vec_id % 100 = 0),
p as (select a, b as p, score as ps from s where same qualify row_number() over (partition by a order by score desc, b) <= 5),
n as (select a, p, ps, b, score, row_number() over (partition by a, p order by score desc, b) as place from p join s using (a) where not same and 30 * ps <= 100 * score and 100 * score <= 90 * ps)
select a as anchor_id, p as positive_id, place::int as rank, b as negative_id, ps as positive_score, score as negative_score from n where place <= 10"""


def _op12(clusters: int, rounds: int, scale: int, size: int, seed: int) -> str:
    """A nearest centroid by all distances, round by round."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::bigint"
    ctes = [
        f"v as (select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings where len(embedding) = {size} and {_WHOLE})",
        f"c0 as (select (row_number() over (order by coalesce(sha256('{seed}:' || vec_id), '~'), v) - 1)::int as k, v as c from v qualify k < {clusters})",
    ]
    for r in range(rounds + 1):
        ctes.append(f"a{r} as (select vec_id, v, arg_min(k, d * {clusters} + k) as k, min(d) as d from (select vec_id, v, k, {distance} as d, row from (select *, row_number() over () as row from v), c{r}) group by row, vec_id, v)")
        if r < rounds:
            ctes.append(f"s{r} as (select k, i, sum(x)::bigint as s, count(*)::bigint as n from (select k, unnest(v) as x, unnest(range({size})) as i from a{r}) group by 1, 2)")
            ctes.append(f"m{r} as (select k, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from s{r} group by 1)")
            ctes.append(f"c{r + 1} as (select k, coalesce(m{r}.c, c{r}.c) as c from c{r} left join m{r} using (k))")
    last = f"select vec_id, k as cluster, d as distance, sum(d) over (partition by k)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256 from a{rounds} join c{rounds} using (k)"
    return "with " + ",\n".join(ctes) + "\n" + last


OP12 = _op12(clusters.CLUSTERS, clusters.ROUNDS, clusters.SCALE, clusters.SIZE, clusters.SEED)

_LINES13 = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))"


def _repeated13(name: str, words: int) -> str:
    """Words inside windows of so many words that stand twice or more in a text."""
    return f"""g{name} as (select doc_id, i, array_to_string(w[i:i + {words - 1}], ' ') as gram from (select doc_id, w, unnest(range(1, len(w) - {words - 2})) as i from d where len(w) >= {words})),
r{name} as (select doc_id, i from g{name} qualify count(*) over (partition by doc_id, gram) > 1),
{name} as (select doc_id, count(distinct k)::bigint as {name} from (select doc_id, unnest(range(i, i + {words})) as k from r{name}) group by 1)"""


OP13 = f"""
with d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w, {_LINES13} as l from documents),
{_repeated13("again", repetition.LEAST)}, {_repeated13("longer", repetition.MOST_LONGEST + 1)},
b as (select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(again, 0) as n_repeat_words, coalesce(longer, 0) > 0 as too_long from d left join again using (doc_id) left join longer using (doc_id)),
f as (select *, n_words < {repetition.LEAST_WORDS} or 100 * n_repeat_words > {repetition.MOST_SHARE} * n_words as base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not too_long and 100 * n_repeat_words <= {repetition.MOST_COVERED} * n_words as kept from f"""

SQL = {"op2_secrets": OP2, "op3_licenses": OP3, "op5_chat": OP5, "op6_decontaminate": OP6, "op7_near_duplicates": OP7, "op11_negatives": OP11, "op12_clusters": OP12, "op13_repetition": OP13}
