"""DuckDB statements for the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op2_line_windows"] = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, p, ls[p + 1] AS a, ls[p + 2] AS b, ls[p + 3] AS c
      FROM (SELECT doc_id, ls, unnest(range(len(ls) - 2)) AS p FROM l WHERE len(ls) >= 3)),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS nth
      FROM w WHERE trim(a) <> '' OR trim(b) <> '' OR trim(c) <> ''),
gone AS (SELECT DISTINCT doc_id, p + d AS p FROM r, (SELECT unnest(range(3)) AS d) WHERE nth > 1),
line AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM l),
kept AS (SELECT line.doc_id, count(*) AS n, count(gone.p) AS n_removed,
                coalesce(string_agg(line, chr(10) ORDER BY line.p) FILTER (WHERE gone.p IS NULL), '') AS text
         FROM line LEFT JOIN gone ON line.doc_id = gone.doc_id AND line.p = gone.p GROUP BY line.doc_id)
SELECT d.doc_id, kept.text, CAST(coalesce(n, 0) AS INTEGER) AS n_lines,
       CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN kept USING (doc_id)
"""


def _share(parents: list[str], level: str, weight: str, up: str) -> str:
    """One level of the tree: budget of each child of the table ``up``."""
    key = ", ".join([*parents, level])
    part = "PARTITION BY " + (", ".join(parents) if parents else "1")
    inner = "PARTITION BY " + (", ".join(f"k.{c}" for c in parents) if parents else "1")
    join = " AND ".join(f"k.{c} IS NOT DISTINCT FROM u.{c}" for c in parents) or "TRUE"
    return f"""
SELECT {key}, cap, CASE WHEN is_full THEN cap
       ELSE (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({part})) * w
            // sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({part}) END AS budget
FROM (SELECT *, cap * w_after <= (budget - cap_before) * w AS is_full
      FROM (SELECT k.*, u.budget,
                   coalesce(sum(k.cap) OVER ({inner}
                     ORDER BY k.cap::DOUBLE / w, k.{level}
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS cap_before,
                   (sum(w) OVER ({inner}
                     ORDER BY k.cap::DOUBLE / w, k.{level}
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS w_after
            FROM (SELECT {key}, (sum(n_tokens) * 2)::HUGEINT AS cap, ({weight})::HUGEINT AS w
                  FROM t GROUP BY {key}) k JOIN {up} u ON {join}))"""


SQL["op3_mix_sources"] = f"""
WITH t AS (
  SELECT doc_id, lang, source, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
         CASE WHEN left(md5(coalesce(source, '')), 1) < '4' THEN 'web'
              WHEN left(md5(coalesce(source, '')), 1) < '8' THEN 'books'
              WHEN left(md5(coalesce(source, '')), 1) < 'c' THEN 'news' ELSE 'code' END AS domain
  FROM documents WHERE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) > 0),
root AS (SELECT least(sum(n_tokens)::HUGEINT // 2, sum(n_tokens)::HUGEINT * 2) AS budget FROM t),
l1 AS ({_share([], "domain", "CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'news' THEN 2 ELSE 1 END", "root")}),
l2 AS ({_share(["domain"], "lang", "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END", "l1")}),
l3 AS ({_share(["domain", "lang"], "source", "1", "l2")}),
m AS (SELECT t.*, (budget // (cap // 2))::BIGINT AS passes, (budget % (cap // 2))::BIGINT AS rest,
             md5(concat_ws(':', '17', (budget // (cap // 2))::VARCHAR, t.doc_id::VARCHAR)) AS mark
      FROM t JOIN l3 ON t.domain = l3.domain AND t.lang IS NOT DISTINCT FROM l3.lang
                    AND t.source IS NOT DISTINCT FROM l3.source),
c AS (SELECT *, passes + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lang, source
                                                      ORDER BY mark, doc_id) <= rest THEN 1 ELSE 0 END AS copies
      FROM m)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, copies::BIGINT AS copies FROM c WHERE copies > 0
"""


def _urn(name: str) -> str:
    h = f"md5({name})"
    return ("concat('<urn:uuid:', " + ", '-', ".join(f"substr({h}, {a}, {n})" for a, n in
                                                     ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ", '>')")


def _entities(x: str) -> str:
    for name, char in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&lt;", "<"),
                       ("&gt;", ">"), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&hellip;", "…"),
                       ("&ndash;", "–"), ("&mdash;", "—"), ("&euro;", "€"), ("&laquo;", "«"), ("&raquo;", "»"),
                       ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x


_BARE = "regexp_replace(regexp_replace(regexp_replace(h, '(?s)<!--.*?-->', '', 'g'), " \
        "'(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g')"
_LINES = (f"regexp_replace({_BARE}, '(?i)</?(p|br|div|li|ul|ol|h[1-6]|article|section|nav|footer|header|main|table|tr|"
          "title|head|body|html|blockquote|pre)(/| [^>]*)?>', chr(10), 'g')")
_TEXT = _entities(f"regexp_replace({_LINES}, '<[a-zA-Z/!][^>]*>', '', 'g')")
_TEXT = f"regexp_replace(regexp_replace({_TEXT}, '[ \\t\\r]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
_TEXT = f"trim(trim({_TEXT}, chr(10)), ' ')"

SQL["op6_warc_derivatives"] = f"""
WITH p AS (
  SELECT page_id AS source_id, url AS target_uri, coalesce(html, '') AS h,
         {_urn("concat('response:', coalesce(page_id::VARCHAR, ''), ':', coalesce(url, ''))")} AS refers_to,
         concat(chr(13), chr(10)) AS e
  FROM pages),
b AS (
  SELECT *, 'metadata' AS kind, concat(
    'http-status: 200', e, 'http-content-type: text/html; charset=utf-8', e,
    'title: ', trim(regexp_replace({_entities("regexp_extract(h, '(?i)<title[^>]*>([^<]*)', 1)")},
                                   '[ \\t\\r\\n]+', ' ', 'g')), e,
    'language: ', regexp_replace(regexp_extract(h, '(?i)<html[^>]* lang="([^"]*)"', 1), '[\r\n]+', ' ', 'g'), e,
    'payload-digest: sha256:', sha256(h), e,
    coalesce(array_to_string(list_transform(regexp_extract_all({_BARE}, '(?i)<a [^>]*?href="([^"]*)"', 1),
                                            lambda x: concat('outlink: ', {_entities("x")}, e)), ''), '')) AS block
  FROM p
  UNION ALL BY NAME
  SELECT *, 'conversion' AS kind, {_TEXT} AS block FROM p),
r AS (SELECT *, {_urn("concat(kind, ':', refers_to)")} AS record_id, concat('sha256:', sha256(h)) AS payload_digest,
             concat('sha256:', sha256(block)) AS block_digest, strlen(block) AS n_bytes
      FROM b)
SELECT source_id, kind, record_id, refers_to, target_uri, payload_digest, block_digest, n_bytes, block,
       concat('WARC/1.1', e, 'WARC-Type: ', kind, e, 'WARC-Record-ID: ', record_id, e, 'WARC-Refers-To: ', refers_to, e,
              CASE WHEN target_uri IS NULL THEN '' ELSE concat('WARC-Target-URI: ', replace(replace(target_uri, chr(13), '%0D'), chr(10), '%0A'), e) END,
              'WARC-Date: 2000-01-01T00:00:00Z', e,
              CASE WHEN kind = 'conversion' THEN concat('WARC-Refers-To-Payload-Digest: ', payload_digest, e)
                   ELSE '' END,
              'WARC-Block-Digest: ', block_digest, e, 'Content-Type: ',
              CASE WHEN kind = 'conversion' THEN 'text/plain; charset=utf-8' ELSE 'application/warc-fields' END, e,
              'Content-Length: ', n_bytes, e, e, block) AS record
FROM r
"""


_ESCAPED = ("replace(replace(replace(replace({0}, chr(92), concat(chr(92), chr(92))), '### ', concat(chr(92), 'a')), "
            "'</turn>', concat(chr(92), 'b')), '<:>', concat(chr(92), 'c'))")

SQL["op11_chat_template"] = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', concat(chr(92), '### Assistant: </turn> ok')
           UNION ALL SELECT -7, 1, 'assistant', concat(chr(92), '### Assistant: </turn> ok')),
t AS (SELECT *, CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
                          ELSE 12 + length({_ESCAPED.format("role")}) END + length({_ESCAPED.format("text")}) + 8 AS chars
      FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 (the reflected polynomial 0xEDB88320) of an ASCII text: each byte, then eight shifts."""
    steps = (f"flatten(list_transform(range(1, length({text}) + 1), lambda i: "
             f"[ascii(substr({text}, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))")
    step = ("CASE WHEN o >= 0 THEN xor(c, o) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END")
    return f"xor(list_reduce({steps}, lambda c, o: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


SQL["op13_prefix_trie"] = f"""
WITH t AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                                ORDER BY turn NULLS FIRST, role, text) AS ts
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
k AS (SELECT *, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM t),
r AS (SELECT k.conv_id, list_concat(coalesce(b.ts[1:h], []), k.ts[h + 1:]) AS ts
      FROM k LEFT JOIN t b ON b.conv_id = k.conv_id - k.conv_id % 20),
p AS (SELECT conv_id, len(ts) AS size, unnest(range(len(ts) + 1)) AS depth, ts FROM r),
m AS (SELECT conv_id, size, depth, ts[1:depth] AS prefix, CASE WHEN depth > 0 THEN ts[depth]['text'] ELSE '' END AS word
      FROM p),
n AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
             len(regexp_extract_all(any_value(word), '[^\\x20\\x09-\\x0D]+')) AS words,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '') AS ends,
             count(*) FILTER (WHERE size > depth) = 0 AS is_leaf
      FROM m GROUP BY depth, prefix),
up AS (SELECT n.*, unnest(range(n.depth + 1)) AS top FROM n),
s AS (SELECT top AS depth, prefix[1:top] AS prefix, sum((n_convs - 1) * words) AS saved_tokens,
             count(*) FILTER (WHERE is_leaf) AS n_leaves, count(*) FILTER (WHERE depth = top + 1) AS n_children
      FROM up GROUP BY top, prefix[1:top])
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s ON s.depth = n.depth AND s.prefix = n.prefix
     LEFT JOIN n q ON q.depth = n.depth - 1 AND q.prefix = n.prefix[1:n.depth - 1] AND n.depth > 0
"""


def _field(x: str) -> str:
    return f"coalesce(concat(strlen({x}::VARCHAR), ':', {x}::VARCHAR), '-')"


def _tree(leaves: str, name: str, levels: int) -> str:
    """``leaves`` (grp, i, h): CTEs <name>0 .. <name><levels>, each level's
    nodes with their run and the hashes beside them; a level of one node stays."""
    step = f"{name}0 AS (SELECT grp, i, h, count(*) OVER (PARTITION BY grp) AS n FROM {leaves})"
    for k in range(levels):
        step += f""",
{name}{k + 1} AS (SELECT grp, i // 3 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END
                         AS h, count(*) OVER (PARTITION BY grp) AS n FROM {name}{k} GROUP BY grp, i // 3)"""
    return step


def _beside(name: str, level: int, g: str, i: str, side: str) -> str:
    """The hashes left ('<') or right ('>') of the ancestor of leaf ``i`` at a level."""
    at = f"({i} // {3 ** level})"
    return (f"coalesce((SELECT string_agg(s.h, '' ORDER BY s.i) FROM {name}{level} s WHERE s.grp = {g} "
            f"AND s.i // 3 = {at} // 3 AND s.i {side} {at}), '')")


def _merkle(levels: int = 7, top: int = 4) -> str:
    """Trees of up to 3 ** levels leaves a source, and 3 ** top sources."""
    steps = [("t", k, "p.grp", "p.i") for k in range(levels)] + [("u", k, "''", "p.si") for k in range(top)]
    cols = ", ".join(f"{_beside(n, k, g, i, '<')} AS l{j}, {_beside(n, k, g, i, '>')} AS r{j}, "
                     f"(SELECT any_value(n) FROM {n}{k} x WHERE x.grp = {g}) > 1 AS on{j}"
                     for j, (n, k, g, i) in enumerate(steps))
    folds = ""
    for j in range(len(steps)):
        folds += f""",
f{j + 1} AS (SELECT * REPLACE (CASE WHEN on{j} THEN sha256(concat(l{j}, folded, r{j})) ELSE folded END AS folded) FROM f{j})"""
    leaf = lambda text: "sha256(concat(" + ", ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + "))"
    return f"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS grp, {leaf("text")} AS leaf,
                  CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS tampered
           FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
lv AS (SELECT grp, i, leaf AS h FROM o),
{_tree("lv", "t", levels)},
su AS (SELECT grp AS src, h, row_number() OVER (ORDER BY grp) - 1 AS si FROM t{levels}),
sv AS (SELECT '' AS grp, si AS i, h FROM su),
{_tree("sv", "u", top)},
p AS (SELECT o.*, su.h AS subroot, su.si, (SELECT h FROM u{top}) AS root FROM o JOIN su ON su.src = o.grp),
f0 AS (SELECT *, coalesce(tampered, leaf) AS folded, {cols} FROM p){folds}
SELECT doc_id, leaf, subroot, root, folded AS folded_root, folded = root AS verified,
       sha256(concat({", ".join(f"l{j}, r{j}" for j in range(len(steps)))})) AS proof_sha256
FROM f{len(steps)}
"""


SQL["op12_merkle_manifest"] = _merkle()
