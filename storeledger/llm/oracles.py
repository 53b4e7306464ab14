"""The same results in SQL, for the operators that SQL can express."""

from storeledger.llm import licenses


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    characters = f"list_transform(range(1, length({text}) + 1), lambda i: " \
        f"CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END"
    byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: {bit})"
    start = "CAST(4294967295 AS BIGINT)"
    return f"xor(list_reduce(list_prepend({start}, {characters}), lambda c, b: {byte}), {start})"


# What may follow what was said last: (state, role initial, role made, state then).
_FOLLOWS = (("none", "s", None, "system"), ("none", "u", "user", "user"),
            ("system", "u", "user", "user"), ("user", "a", "assistant", "assistant"),
            ("assistant", "u", "user", "user"))


def _way(cost: str, edit: str, to: str, line: str | None) -> str:
    """An edit before what costs least from ``to`` on."""
    said = f"list_prepend({line}, {to}.said)" if line else f"{to}.said"
    return f"{{'cost': {cost} + {to}.cost, 'audit': '{edit}' || {to}.audit, 'said': {said}}}"


def _row_ways(state: str) -> str:
    """The cheapest edit of a row, the least audit among equals."""
    ways = [_way("3", "D", f"d.from_{state}", None)]
    for of, initial, made, to in _FOLLOWS:
        if of != state:
            continue
        keeps = f"r.must IS NULL AND left(r.role, 1) = '{initial}'"
        keep = _way("r.cut", "K", f"d.from_{to}", "r.role || ':' || r.text")
        ways.append(f"CASE WHEN {keeps} THEN {keep} END")
        if made:
            change = _way("2 + r.cut", "R", f"d.from_{to}", f"'{made}:' || r.text")
            ways.append(f"CASE WHEN r.must IS NULL THEN {change} END")
    return f"list_min([{', '.join(ways)}]) AS row_{state}"


def _with_insert(state: str, prefix: str) -> str:
    ways = [f"row_{state}"] + [
        _way("2", "I", f"{prefix}_{to}", f"'{made}:'")
        for of, _, made, to in _FOLLOWS if of == state and made
    ]
    return f"list_min([{', '.join(ways)}]) AS from_{state}"


_NOTHING = "{'cost': 0, 'audit': '', 'said': CAST([] AS VARCHAR[])}"
_REPAIR = f"""
    WITH RECURSIVE given AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
                   || coalesce(CAST(turn AS VARCHAR), ' ') AS key
        FROM conversations
    ), coded AS (
        SELECT *, {_crc32("key")} % 20 AS code FROM given
    ), damaged AS (
        SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
               CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END
                   AS text
        FROM coded JOIN (VALUES (1), (2)) AS copy(n) ON code <> 0 AND (n = 1 OR code = 3)
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
                   AS place
        FROM damaged
    ), judged AS (
        SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS nth,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
        FROM placed
    ), rows AS (
        SELECT *, CASE WHEN seen = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' END AS must,
               CASE WHEN seen <> '' AND nth = 1 AND right(seen, 1) NOT IN ('.', '!', '?')
                    THEN 1 ELSE 0 END AS cut
        FROM judged
    ), facts AS (
        SELECT conv_id, count(*) AS n,
               coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (must = 'blank') AS blank,
               count(*) FILTER (must = 'duplicate') AS duplicate,
               count(*) FILTER (cut = 1) AS truncated,
               count(*) FILTER (before IS NOT NULL
                   AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows GROUP BY conv_id
    ), steps AS (
        SELECT conv_id, n AS place, {_NOTHING} AS from_none,
               {{'cost': 4, 'audit': 'II', 'said': ['user:', 'assistant:']}} AS from_system,
               {{'cost': 2, 'audit': 'I', 'said': ['assistant:']}} AS from_user,
               {_NOTHING} AS from_assistant
        FROM facts
        UNION ALL
        SELECT conv_id, place, {_with_insert("none", "from")}, {_with_insert("system", "from")},
               from_user, from_assistant
        FROM (SELECT *, {_with_insert("user", "row")}, {_with_insert("assistant", "row")}
              FROM (SELECT d.conv_id, d.place - 1 AS place,
                           {", ".join(map(_row_ways, ("none", "system", "user", "assistant")))}
                    FROM steps d JOIN rows r
                      ON d.place = r.place AND d.conv_id IS NOT DISTINCT FROM r.conv_id))
    )
    SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
           coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, CAST(coalesce(from_none.cost, 0) AS BIGINT) AS cost,
           coalesce(from_none.audit, '') AS audit,
           sha256(coalesce(array_to_string(from_none.said, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) every
    LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM every.conv_id
    LEFT JOIN (SELECT * FROM steps WHERE place = 0) s
      ON s.conv_id IS NOT DISTINCT FROM every.conv_id
"""

SQL = {
    "op1_chat_format": r"""
        WITH turn AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL
            SELECT -7, i, ['user', 'assistant'][i + 1], '\### Assistant: </turn> ok'
            FROM range(2) AS two(i)
        ), sized AS (
            SELECT *,
                length('<turn>### : </turn>') + 1
                + CASE WHEN regexp_matches(role || text, '[\\]|</?turn>|### ')
                            OR regexp_matches(role, '[:<]')
                  THEN length(regexp_replace(role, '[\\:<]', 'xx', 'g'))
                       + length(text) + len(regexp_extract_all(text, '[\\]|</?turn>|### '))
                  ELSE length(role) + length(text) END AS chars
            FROM turn
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(concat(role, chr(10), text, chr(10)), ''
                                 ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
                   AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                               FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op3_license_scan": licenses.oracle_sql(),
    "op5_line_dedup": """
        WITH line AS (
            SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS position
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        ), keyed AS (
            SELECT *, translate(
                trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM line
        ), cut AS (
            SELECT key, max(doc_id) AS newest FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), marked AS (
            SELECT k.doc_id, k.line, k.position, coalesce(k.doc_id <> c.newest, false) AS dropped
            FROM keyed k LEFT JOIN cut c ON k.key = c.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY position)
                               FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_repair": _REPAIR,
}
