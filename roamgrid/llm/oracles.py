"""DuckDB SQL for the registered queries that SQL can express, over whole tables."""

from __future__ import annotations

from roamgrid.llm.mixing import progress_sql
from roamgrid.llm.url_rules import LISTED, MIN_CONFIDENCE, MIN_ROWS, MIN_SUPPORT, SEED_WORDS

_WORDS = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _components(nodes: str, links: str) -> str:
    """``reach``: every node with the nodes that links lead to, itself included."""
    return f"""both_ways AS (SELECT u, v FROM {links} UNION SELECT v, u FROM {links}),
    reach(a, b) AS (SELECT id, id FROM {nodes} UNION SELECT r.a, w.v FROM reach r JOIN both_ways w ON r.b = w.u),
    parts AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""


def _listed(column: str) -> str:
    """The longest listed rule that fits ``host`` and ``path``: its text or its verdict."""
    longest = sorted(LISTED, key=lambda r: (len(r[0]) + len(r[1]), r), reverse=True)
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if column == 'rule' else v}'"
        for h, p, v in longest) + " END"


def _crc32(text: str) -> str:
    """The checksum of an ASCII text, as an unsigned number."""
    byte_codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    eight = "list_reduce([xor(acc, b)] || range(8), lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(list_reduce([4294967295::BIGINT] || {byte_codes}, lambda acc, b: {eight}), 4294967295)"


# Best edits by state of the grammar, as texts of a nine-digit cost and the audit: the least text is the answer.
_NEXT = (2, 2, 3, 2)


def _after(state: str, cost: str, edit: str) -> str:
    return f"lpad(CAST(CAST(substr({state}, 1, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || '{edit}' || substr({state}, 10)"


def _repair_step() -> str:
    """One turn ``x`` (``letter, cut``) before the costs ``acc``: first the turn's own edits, then insertions before it."""
    keep = {0: "CASE x.letter WHEN 's' THEN acc.f1 WHEN 'u' THEN acc.f2 END", 1: "CASE x.letter WHEN 'u' THEN acc.f2 END",
            2: "CASE x.letter WHEN 'a' THEN acc.f3 END", 3: "CASE x.letter WHEN 'u' THEN acc.f2 END"}
    own = ", ".join(f"""f{q} := least({_after(f'acc.f{q}', '3', 'D')}, {_after(keep[q], 'x.cut', 'K')},
        CASE WHEN x.letter <> 'x' THEN {_after(f'acc.f{_NEXT[q]}', '2 + x.cut', 'R')} END)""" for q in range(4))
    more = "struct_pack(" + ", ".join(f"f{q} := least(g.f{q}, {_after(f'g.f{_NEXT[q]}', '2', 'I')})" for q in range(4)) + ")"
    step = f"[struct_pack({own})]"
    for _ in range(4):
        step = f"list_transform({step}, lambda g: {more})"
    return f"({step})[1]"


_VALID = """embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

ORACLES = {
    "op2_embedding_forest": f"""
    WITH RECURSIVE v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE {_VALID} AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT a.id AS u, b.id AS v FROM v a JOIN v b ON a.label = b.label AND a.id < b.id
        AND list_cosine_similarity(a.e, b.e) >= 0.93),
    nodes AS (SELECT vec_id AS id FROM embeddings), {_components('nodes', 'links')}
    SELECT n.id AS vec_id, (SELECT count(*) FROM both_ways w WHERE w.u = n.id) AS n_links, p.component_id,
        p.component_id = n.id AS kept
    FROM nodes n JOIN parts p ON p.id = n.id""",
    "op4_url_rules": f"""
    WITH RECURSIVE u0 AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
    u1 AS (SELECT *, split_part(split_part(rest, '#', 1), '?', 1) AS place FROM u0),
    u2 AS (SELECT page_id, url, coalesce(translate(split_part(place, '/', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
        CASE WHEN strpos(place, '/') > 0 THEN substr(place, strpos(place, '/')) ELSE '' END AS path,
        CASE WHEN strpos(url, '?') > 0 THEN regexp_extract(url, '\\?([^#]*)', 1) ELSE '' END AS query FROM u1),
    u3 AS (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS names FROM u2),
    u4 AS (SELECT *, list_slice(names, 1, greatest(0, len(names) - 2)) AS labels FROM u3),
    u5 AS (SELECT *, list_filter(flatten(list_transform(labels, lambda x: string_split(x, '-'))), lambda x: x <> '') AS words FROM u4),
    urls AS (SELECT page_id, host, path, {_listed('rule')} AS rule, {_listed('verdict')} AS listed, words,
        CASE WHEN strpos(url, '://') > 0 AND host <> '' THEN list_distinct(flatten([
            ['scheme:' || lower(split_part(url, '://', 1))],
            ['site:' || array_to_string(list_slice(names, greatest(0, len(names) - 2) + 1, len(names)), '.')],
            list_transform(list_filter(labels, lambda x: contains(x, '-')), lambda x: 'host:' || x),
            list_transform(words, lambda x: 'word:' || x),
            list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path:' || regexp_replace(x, '[0-9]+', '#', 'g')),
            list_transform(list_filter(string_split(query, '&'), lambda x: x <> ''), lambda x: 'query:' || split_part(x, '=', 1)),
            CASE WHEN strpos(url, '#') > 0 THEN ['anchor'] ELSE [] END])) ELSE [] END AS tokens FROM u5),
    flags AS (SELECT page_id, bool_or(bad) AS bad FROM (SELECT doc_id AS page_id, quality = 0 OR toxic = 1 AS bad FROM labels
        UNION ALL SELECT page_id, true FROM urls WHERE list_has_any(words, {list(SEED_WORDS)!r})) GROUP BY page_id),
    marked AS (SELECT u.page_id, tokens, bad FROM urls u JOIN flags f ON u.page_id = f.page_id WHERE len(tokens) > 0 AND bad IS NOT NULL),
    least AS (SELECT greatest({MIN_ROWS}, ceil({MIN_SUPPORT}::DOUBLE * count(*))) AS n FROM marked),
    tok AS (SELECT page_id, bad, unnest(tokens) AS t FROM marked),
    combos AS (SELECT page_id, [t] AS rule_tokens, bad FROM tok
        UNION ALL SELECT c.page_id, list_append(c.rule_tokens, b.t), c.bad FROM combos c JOIN tok b ON c.page_id = b.page_id AND c.rule_tokens[-1] < b.t),
    rules AS (SELECT rule_tokens, count_if(bad)::DOUBLE / count(*) AS confidence FROM combos GROUP BY rule_tokens
        HAVING count_if(bad) >= (SELECT n FROM least) AND count_if(bad)::DOUBLE / count(*) >= {MIN_CONFIDENCE}::DOUBLE),
    pruned AS (SELECT * FROM rules r WHERE NOT EXISTS (SELECT 1 FROM rules p WHERE len(p.rule_tokens) < len(r.rule_tokens)
        AND list_has_all(r.rule_tokens, p.rule_tokens) AND p.confidence >= r.confidence)),
    hits AS (SELECT u.page_id, max(p.confidence) AS confidence FROM urls u JOIN pruned p ON list_has_all(u.tokens, p.rule_tokens)
        WHERE u.listed IS NULL GROUP BY u.page_id)
    SELECT u.page_id, host, path, rule, coalesce(listed, CASE WHEN confidence IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, confidence
    FROM urls u LEFT JOIN hits h ON u.page_id = h.page_id""",
    "op5_mixing": f"""
    WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
        CAST(coalesce(len(regexp_extract_all(text, {_WORDS})), 0) AS BIGINT) AS size FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT source, source_size, 2 * source_size AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS schedule,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
    l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) - CAST(sum(cap) OVER o - cap AS DOUBLE))
        / CAST(sum(weight) OVER () - (sum(weight) OVER o - weight) AS DOUBLE) AS level FROM w
        WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
    t AS (SELECT source, source_size, schedule, CASE WHEN cap <= max(level) OVER () * weight THEN CAST(cap AS DOUBLE)
        ELSE max(level) OVER () * weight END AS target FROM l),
    m AS (SELECT d.doc_id, d.size, t.source_size, t.schedule, t.target,
        CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) - d.size AS DOUBLE)
        + d.size / CAST(2 AS DOUBLE) AS middle FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    c AS (SELECT *, CAST(middle < target AS INT) + CAST(middle + source_size < target AS INT) AS copies FROM m)
    SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies,
        CASE WHEN copies > 0 THEN {progress_sql('middle / target', 'schedule', mark='::DOUBLE')} END
        AS first_position FROM c""",
    "op7_knn_join": f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE {_VALID}),
    scored AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
        FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op10_minhash_dedup": f"""
    WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORDS}) AS ws
        FROM documents),
    sh AS (SELECT DISTINCT id, array_to_string(list_slice(ws, i, i + 3), ' ') AS s FROM
        (SELECT id, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS i FROM w WHERE len(ws) > 0)),
    sizes AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
    shared AS (SELECT a.id AS u, b.id AS v, count(*) AS common FROM sh a JOIN sh b ON a.s = b.s AND a.id < b.id GROUP BY a.id, b.id),
    links AS (SELECT u, v FROM shared JOIN sizes a ON a.id = u JOIN sizes b ON b.id = v WHERE 100 * common >= 80 * (a.n + b.n - common)),
    {_components('w', 'links')}
    SELECT w.id AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, p.component_id, p.component_id = w.id AS kept
    FROM w JOIN parts p ON p.id = w.id LEFT JOIN sizes s ON s.id = w.id""",
    "op12_repair_dawg": f"""
    WITH p AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
    d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM p WHERE kind <> 0),
    r AS (SELECT *, row_number() OVER o AS pos, left(role, 1) AS initial, NOT regexp_matches(text, {_WORDS}) AS blank,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
        NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, lag(left(role, 1)) OVER o AS initial_before
        FROM d WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
    l AS (SELECT *, CASE WHEN blank OR seen THEN 'x' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS letter FROM r),
    c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
        count_if(NOT blank AND seen) AS duplicate, count_if(NOT blank AND NOT seen AND cut) AS truncated,
        count_if(initial_before IS NOT NULL AND initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
        list(struct_pack(letter := letter, cut := CAST(cut AS INTEGER)) ORDER BY pos DESC) AS letters FROM l GROUP BY conv_id),
    f AS (SELECT *, list_reduce(letters, lambda acc, x: {_repair_step()},
        struct_pack(f0 := '000000000', f1 := '000000004II', f2 := '000000002I', f3 := '000000000')).f0 AS best FROM c),
    e AS (SELECT conv_id, substr(best, 10) AS audit, generate_subscripts(string_split(substr(best, 10), ''), 1) AS i FROM f WHERE best <> '000000000'),
    t AS (SELECT conv_id, i, substr(audit, i, 1) AS edit,
        length(replace(left(audit, i), 'I', '')) AS pos, length(replace(left(audit, i), 'D', '')) AS out,
        length(replace(audit, 'D', '')) % 2 AS has_system FROM e),
    o AS (SELECT t.conv_id, t.out, CASE WHEN edit = 'K' THEN l.role WHEN (t.out - has_system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
        || CASE WHEN edit = 'I' THEN '' ELSE l.text END AS line
        FROM t LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM t.conv_id AND l.pos = t.pos AND edit <> 'I' WHERE edit <> 'D'),
    s AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY out)) AS repaired_sha256 FROM o GROUP BY conv_id),
    every AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
        CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
        CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(CAST(substr(best, 1, 9) AS INTEGER), 0) AS BIGINT) AS cost,
        coalesce(substr(best, 10), '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
    FROM every k LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM k.conv_id""",
    "op11_prefix_trie": f"""
    WITH t AS (SELECT conv_id, words, print, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, print) AS k FROM (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(len(regexp_extract_all(text, {_WORDS})), 0) AS words,
            sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS print
        FROM conversations WHERE conv_id IS NOT NULL)),
    c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM t),
    heads AS (SELECT c.conv_id, t.k AS depth, print, words FROM c JOIN t ON t.conv_id = c.base AND t.k <= c.h),
    r AS (SELECT * FROM heads UNION ALL
        SELECT c.conv_id, t.k - c.h + (SELECT count(*) FROM heads WHERE heads.conv_id = c.conv_id), print, words
        FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
    p AS (SELECT conv_id, depth, words, string_agg(print, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
        UNION ALL SELECT conv_id, 0, 0, '' FROM c),
    ends AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256 FROM (
        SELECT conv_id, max(path) AS path FROM p GROUP BY conv_id) GROUP BY path),
    n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM p GROUP BY path, depth),
    m AS (SELECT *, CASE WHEN depth > 0 THEN left(path, CAST(64 * (depth - 1) AS INTEGER)) END AS above FROM n),
    k AS (SELECT above, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY above),
    x AS (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN k ON m.path = k.above)
    SELECT a.conv_id, a.depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children,
        (SELECT count(*) FROM x s WHERE starts_with(s.path, a.path) AND s.n_children = 0) AS n_leaves,
        (SELECT CAST(sum((s.n_convs - 1) * s.words) AS BIGINT) FROM x s WHERE starts_with(s.path, a.path)) AS saved_tokens,
        coalesce(ends_sha256, sha256('')) AS ends_sha256
    FROM x a LEFT JOIN x b ON a.above = b.path LEFT JOIN ends ON ends.path = a.path""",
}
