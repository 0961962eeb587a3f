"""DuckDB statements for the queries that SQL can express on whole tables."""

from __future__ import annotations

from tidemark.llm import licenses, pii

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def url_filter(rules: tuple) -> str:
    rows = ", ".join(f"({_quoted(h)}, {_quoted(p)}, {_quoted(v)})" for h, p, v in rules)
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
        WITH rules(h, p, v) AS (VALUES {rows}),
             parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{parts}', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
                              coalesce(regexp_extract(url, '{parts}', 2), '') AS path FROM pages),
             best AS (SELECT page_id, arg_max(struct_pack(rule := h || p, v := v), length(h || p)) AS x
                      FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1)
        SELECT parts.*, x.rule AS rule, coalesce(x.v, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)"""


def _base32(hexadecimal: str) -> str:
    def digit(i: int) -> str:
        value = f"CAST('0x' || substring({hexadecimal}, {i // 4 * 5 + 1}, 5) AS INTEGER)"
        return f"substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({value} >> {15 - i % 4 * 5}) & 31) + 1, 1)"

    return " || ".join(digit(i) for i in range(32))


def warc() -> str:
    return f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
             d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS h,
                          max(page_id) OVER (PARTITION BY body) AS first FROM p)
        SELECT page_id, payload_bytes, {_base32("h")} AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact FROM d"""


def contained_items() -> str:
    return f"""
        WITH items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
             wanted AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)), lambda i: w[i:i + k - 1])) AS s
                        FROM (SELECT *, least(5, len(w)) AS k FROM items WHERE len(w) > 0)),
             sizes AS (SELECT item_id, count(*) AS n FROM wanted GROUP BY 1),
             have AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)), lambda i: w[i:i + k - 1])) AS s
                      FROM (SELECT doc_id, {_WORDS} AS w FROM documents), (SELECT DISTINCT k FROM wanted) WHERE len(w) >= k),
             shared AS (SELECT doc_id, item_id, count(*) AS m FROM have JOIN wanted USING (k, s) GROUP BY ALL)
        SELECT doc_id, item_id, n AS n_item_shingles, m AS n_shared, m / n AS containment
        FROM shared JOIN sizes USING (item_id) WHERE m >= 0.8 * n - 1e-9"""


def jaccard_components() -> str:
    return f"""
        WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
             sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [w] ELSE
                        list_transform(range(1, CAST(len(w) - 3 AS BIGINT)), lambda i: w[i:i + 4]) END) AS s FROM words WHERE len(w) > 0),
             sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
             common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM sets a JOIN sets b USING (s)
                        WHERE a.doc_id <> b.doc_id GROUP BY ALL),
             links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                       WHERE 100 * m >= 80 * (x.n + y.n - m)),
             reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id
        FROM documents LEFT JOIN sizes USING (doc_id)"""


def personal_data() -> str:
    iban = pii.KINDS[4].pattern.removeprefix("(?<![A-Za-z0-9])").removesuffix("(?![A-Za-z0-9])")
    # The stated patterns, without the possessive repeats and look-behinds that only spare work.
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": rf"\b(?:{iban})\b",
        "ssn": r"\b[0-9]{3}_[0-9]{2}_[0-9]{4}\b",
    }
    # \b stands for the look-around once the characters on one side of it are those of a word, one for one
    seen = {"iban": "replace(text, '_', '-')", "ssn": "replace(regexp_replace(text, '[^0-9-]', ' ', 'g'), '-', '_')"}
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    double = "list_transform(list_reverse(string_split({0}, '')), lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INTEGER) ELSE " \
             "CAST(c AS INTEGER) * 2 - 9 * CAST(CAST(c AS INTEGER) > 4 AS INTEGER) END)"  # fmt: skip
    flat = "replace(hit, ' ', '')"
    moved = f"string_split(substring({flat}, 5) || substring({flat}, 1, 4), '')"
    number = f"""string_split(array_to_string(list_transform({moved}, lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c
        ELSE CAST(ascii(c) - 55 AS VARCHAR) END), ''), '')"""
    mod97 = f"list_reduce(list_transform({number}, lambda c: CAST(c AS BIGINT)), lambda a, b: (a * 10 + b) % 97)"
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(hit, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST('0' || right(x, 3) AS INTEGER) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 14 AND 19 AND list_sum({double.format(digits)}) % 10 = 0",
        "phone": f"length({digits}) BETWEEN 10 AND 15",
        "iban": f"length({flat}) BETWEEN 15 AND 34 AND {mod97} = 1",
        "ssn": "NOT regexp_matches(hit, '^(?:000|666|9)|_00_|_0000$')",
    }
    found = []
    for number_, kind in enumerate(pii.KINDS):
        found.append(f"""
            SELECT doc_id, {number_} AS kind, '{kind.name}' AS name, start, start + length(hit) AS stop, {valid[kind.name]} AS ok,
                   {kind.score} + CASE WHEN regexp_matches(lower(substring(text, greatest(start - {pii.NEAR}, 0) + 1,
                     length(hit) + {2 * pii.NEAR})), '{kind.context}') THEN {pii.BOOST} ELSE 0 END AS score
            FROM (SELECT doc_id, text, hits[i] AS hit, CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS BIGINT) AS start
                  FROM (SELECT *, unnest(range(1, CAST(len(hits) + 1 AS BIGINT))) AS i FROM (
                    SELECT doc_id, text, regexp_split_to_array(seen, '{patterns[kind.name]}') AS gaps,
                           regexp_extract_all(seen, '{patterns[kind.name]}') AS hits
                    FROM (SELECT *, {seen.get(kind.name, "text")} AS seen FROM docs))))""")
    base = sum(k.base for k in pii.KINDS)
    counts = ", ".join(f"count(*) FILTER (name = '{k.name}') AS n_{k.name}" for k in pii.KINDS)
    span = "name || ':' || start || ':' || stop"
    return f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
             found AS ({" UNION ALL ".join(found)}),
             kept AS (SELECT * FROM found WHERE ok AND (kind < {base} OR score >= {pii.THRESHOLD}))
        SELECT doc_id, {counts}, sha256(coalesce(string_agg({span}, ',' ORDER BY start, kind) FILTER (kind < {base}), '')) AS base_sha256,
               coalesce(string_agg({span}, ',' ORDER BY start, kind), '') AS spans,
               coalesce(string_agg(CAST(round(score, 2) AS VARCHAR), ',' ORDER BY start, kind), '') AS scores
        FROM docs LEFT JOIN kept USING (doc_id) GROUP BY doc_id"""


def license_report() -> str:
    end, line, blank = "\u0001", "\u0002", r"\x20\t-\r"
    text = f"regexp_replace(translate(lower(text), '{end}{line}\u00a7', '   '), '[.!?;:]+[{blank}]+', '{end}', 'g')"
    text = f"regexp_replace({text}, '\\r\\n?|\\n', '{line}', 'g')"
    for _ in range(2):  # a dot inside a number stays; twice, since matches don't overlap
        text = f"regexp_replace({text}, '([0-9])\\.([0-9])', '\\1\u00a7\\2', 'g')"
    text = f"replace(regexp_replace({text}, '[^a-z0-9\u00a7{end}{line}]+', ' ', 'g'), '\u00a7', '.')"
    text = f"trim(regexp_replace({text}, ' ?([{end}{line}]) ?', '\\1', 'g'), ' ')"

    # Every mark is doubled: a match may then consume one on either side, where the operator looks around.
    def doubled(sentence: str) -> str:
        name = f"[a-z0-9.]+(?:(?:  |{end}{end}|{line}{line})[a-z0-9.]+){{0,{licenses.NAME - 1}}}?"
        return f"(?:  |{line}{line})".join(name if w == "*" else w.replace(".", "[.]") for w in sentence.split())

    ordered = sorted(licenses.SENTENCES, key=lambda x: (-len(x), x))
    every = "|".join(map(doubled, ordered))
    long = "|".join(doubled(x) for x in ordered if len(x.split()) >= licenses.LONG)
    close = f"(?:$|[{end}{line}])"
    wanted = f"(?:^|[{end}{line} ])({long}){close}|(?:^|[{end}{line}])(?:[0-9]{{1,2}}  )?({every}){close}"
    table = ", ".join(f"({_quoted(x)}, '{i}')" for x, i in licenses.SENTENCES.items())
    plain = f"replace(replace(hit, '{line}{line}', ' '), '  ', ' ')"
    named = "".join(f"WHEN regexp_full_match(hit, '{doubled(x)}') THEN '{i}' " for x, i in licenses.SENTENCES.items() if "*" in x.split())
    twice = f"replace(replace(replace(norm, ' ', '  '), '{end}', '{end}{end}'), '{line}', '{line}{line}')"
    state = "SELECT *, list_aggregate(list_transform(ids, lambda x: '<' || x || '>'), 'string_agg', '') AS r0 FROM found"
    names = []
    for n, (sequence, name) in enumerate(licenses.RULES):
        run = "".join(f"<{x}>" for x in sequence)
        state = f"SELECT *, replace(r{n}, '{run}', '|') AS r{n + 1} FROM ({state})"
        names.append(f"CASE WHEN contains(r{n}, '{run}') THEN '{name}' END")
    last = f"r{len(licenses.RULES)}"
    return f"""
        WITH known(sentence, id) AS (VALUES {table}),
             norm AS (SELECT doc_id, {text} AS norm FROM documents WHERE regexp_matches(text, '{licenses._GATE}')),
             hits AS (SELECT doc_id, regexp_extract_all(x, '{wanted}', 1) AS a, regexp_extract_all(x, '{wanted}', 2) AS b
                      FROM (SELECT doc_id, {twice} AS x FROM norm)),
             cut AS (SELECT doc_id, unnest(range(1, CAST(len(a) + 1 AS BIGINT))) AS i,
                            unnest(list_transform(list_zip(a, b), lambda z: coalesce(z[1], z[2]))) AS hit FROM hits),
             found AS (SELECT d.doc_id, coalesce(list(c.id ORDER BY c.i) FILTER (c.id IS NOT NULL), []) AS ids FROM documents d
                       LEFT JOIN (SELECT doc_id, i, coalesce(k.id, CASE {named} END) AS id
                                  FROM cut LEFT JOIN known k ON k.sentence = {plain}) c USING (doc_id) GROUP BY 1)
        SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
               array_to_string(list_filter(names, lambda x, i: x IS NOT NULL AND list_position(names, x) = i), ',') AS licenses,
               len(regexp_extract_all(coalesce({last}, ''), '<')) AS n_unmatched
        FROM (SELECT *, [{", ".join(names)}] AS names FROM ({state}))"""


def fill_in_middle() -> str:
    def number(group: int) -> str:
        return f"CAST('0x' || substring(h, {8 * group + 1}, 8) AS BIGINT)"

    def joined(first: str, last: str) -> str:
        return f"array_to_string(lines[{first} : {last}], '')"

    return f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h FROM documents),
             cut AS (SELECT *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS lines FROM docs),
             drawn AS (SELECT *, len(lines) AS n, {number(0)} % (len(lines) + 1) AS c1, {number(1)} % (len(lines) + 1) AS c2,
                              CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                                     OR {number(2)} % 100 >= 100 THEN 'plain'
                                   WHEN {number(3)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut),
             parts AS (SELECT *, {joined("1", "least(c1, c2)")} AS p, {joined("least(c1, c2) + 1", "greatest(c1, c2)")} AS m,
                              {joined("greatest(c1, c2) + 1", "n")} AS s FROM drawn)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM parts"""


def centroid_clusters(k: int = 8, rounds: int = 10) -> str:
    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
            SELECT r, vec_id, v, unnest(list_min(list_transform(c, lambda q: struct_pack(
                     d := CAST(list_sum(list_transform(list_zip(v, q.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), j := q.j))))
            FROM kept, (SELECT list(struct_pack(j := j, v := v) ORDER BY j) AS c FROM c{i}))"""

    def moved(i: int) -> str:
        return f"""s{i} AS (SELECT j, list(f ORDER BY p) AS v FROM (
              SELECT j, p, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS f
              FROM (SELECT j, unnest(v) AS x, unnest(range(1, 65)) AS p FROM a{i}) GROUP BY 1, 2) GROUP BY 1),
            c{i + 1} AS MATERIALIZED (SELECT j, CAST(coalesce(s{i}.v, c{i}.v) AS BIGINT[]) AS v FROM c{i} LEFT JOIN s{i} USING (j))"""

    steps = ", ".join(f"{assigned(i)}, {moved(i)}" for i in range(rounds))
    return f"""
        WITH kept AS MATERIALIZED (
               SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
               FROM embeddings WHERE len(embedding) = 64
                 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
             c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS j, v FROM (
               SELECT sha256('3:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY 1, 2 LIMIT {k})),
             {steps}, {assigned(rounds)}
        SELECT vec_id, a{rounds}.j AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{rounds}.j) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (j)"""
