"""SQL for the queries of operators 11 and 12."""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(range(8), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(c, x))"
    chars = f"list_transform(string_split({text}, ''), lambda y: CAST(ord(y) AS BIGINT))"
    return f"xor(list_reduce(list_filter({chars}, lambda y: y > 0), lambda c, x: {bits}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _plus(state: str, cost, edits: str) -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edits}'}} END"


def _least(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"


REPAIR = f"""
    WITH RECURSIVE src AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
    dam AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM src)),
    num AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS pos, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS initial
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM dam)),
    f AS (
        SELECT *, CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM num),
    e AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CAST(fault = 'truncated' AS BIGINT) AS t FROM f),
    dp(conv_id, pos, z, s, u, a) AS (
        SELECT conv_id, CAST(0 AS BIGINT), {{'c': CAST(0 AS BIGINT), 'a': ''}}, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)), CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)), CAST(NULL AS STRUCT(c BIGINT, a VARCHAR))
        FROM (SELECT DISTINCT conv_id FROM conversations)
        UNION ALL
        SELECT q.conv_id, e.pos, {_plus('z', 3, 'D')},
               {_least(_plus('s', 3, 'D'), "CASE WHEN NOT must AND initial = 's' THEN " + _plus('z', 't', 'K') + " END")},
               {_least(_plus('iu', 3, 'D'), *[f"CASE WHEN NOT must AND initial = 'u' THEN {_plus(x, 't', 'K')} END" for x in ('z', 's', 'ia')], *[f"CASE WHEN NOT must THEN {_plus(x, 't + 2', 'R')} END" for x in ('z', 's', 'ia')])},
               {_least(_plus('ia', 3, 'D'), "CASE WHEN NOT must AND initial = 'a' THEN " + _plus('iu', 't', 'K') + " END", "CASE WHEN NOT must THEN " + _plus('iu', 't + 2', 'R') + " END")}
        FROM (SELECT *, {_least('a', _plus('iu', 2, 'I'))} AS ia FROM (SELECT *, {_least('u', _plus('z', 2, 'I'), _plus('s', 2, 'I'), _plus('a', 2, 'I'))} AS iu FROM dp)) q
        JOIN e ON e.conv_id IS NOT DISTINCT FROM q.conv_id AND e.pos = q.pos + 1),
    best AS (SELECT conv_id, {_least('z', 'a', _plus('u', 2, 'I'), _plus('s', 4, 'II'))} AS b FROM (SELECT * FROM dp QUALIFY pos = max(pos) OVER (PARTITION BY conv_id))),
    edits AS (
        SELECT conv_id, k, edit, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS pos, count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS place
        FROM (SELECT conv_id, unnest(string_split(b.a, '')) AS edit, generate_subscripts(string_split(b.a, ''), 1) AS k FROM best WHERE b.a <> '')),
    said AS (
        SELECT d.conv_id, place, edit, role, text, place - CAST(max(CASE WHEN place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY d.conv_id) AS BIGINT) AS p
        FROM edits d LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM d.conv_id AND e.pos = d.pos AND d.edit <> 'I' WHERE edit <> 'D'),
    told AS (
        SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN p % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS body
        FROM said GROUP BY conv_id),
    n AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY conv_id)
    SELECT best.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           b.c AS cost, b.a AS audit, sha256(coalesce(body, '')) AS repaired_sha256
    FROM best LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM best.conv_id"""


def _item(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_item, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree(name: str, nodes: str) -> str:
    """name: all nodes of the trees over nodes (grp, idx, h, n); name_s: the siblings of those below a root."""
    return f"""{name} AS (
        SELECT 0 AS level, grp, idx, h, n FROM {nodes}
        UNION ALL SELECT level + 1, grp, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY level, grp, idx // 3, n),
    {name}_s AS (
        SELECT a.level, a.grp, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
        FROM {name} a JOIN {name} b ON a.level = b.level AND a.grp = b.grp AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY a.level, a.grp, a.idx)"""


MERKLE = f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, coalesce('.' || source, '') AS grp, {_leaf('text')} AS h,
               CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS told FROM documents),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
    {_tree('low', 'ranked')},
    subs AS (SELECT grp AS member, h, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n, '' AS grp FROM low WHERE n = 1),
    {_tree('high', 'subs')},
    steps AS (
        SELECT d.grp, d.idx, s.level, l, r FROM ranked d JOIN low_s s ON s.grp = d.grp AND s.idx = d.idx // CAST(pow(3, s.level) AS BIGINT)
        UNION ALL
        SELECT d.grp, d.idx, 100 + s.level, l, r FROM ranked d JOIN subs ON subs.member = d.grp JOIN high_s s ON s.idx = subs.idx // CAST(pow(3, s.level) AS BIGINT)),
    paths AS (SELECT grp, idx, list(l || '|' || r ORDER BY level) AS path FROM steps GROUP BY grp, idx),
    told AS (
        SELECT d.doc_id, d.h AS leaf, subs.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
               list_reduce(list_prepend(told, coalesce(path, [])), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root, nullif(substr(d.grp, 2), '') AS source, d.idx AS rank
        FROM ranked d JOIN subs ON subs.member = d.grp LEFT JOIN paths p ON p.grp = d.grp AND p.idx = d.idx)
    SELECT *, folded_root = root AS verified FROM told"""
