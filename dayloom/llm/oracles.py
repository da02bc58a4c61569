"""SQL for the queries of this subpackage that SQL can express."""
from __future__ import annotations

_HOST_PATH = """
SELECT page_id, url,
       CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
FROM pages
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Base 32 of a SHA-1: each 5 hexadecimal digits are 4 characters.
_DIGEST = f"""
array_to_string(list_transform(range(8), lambda i:
    array_to_string(list_transform([15, 10, 5, 0], lambda s:
        '{_BASE32}'[(((('0x' || sha1(payload)[i * 5 + 1 : i * 5 + 5])::INTEGER >> s) & 31) + 1)::INTEGER]), '')), '')
"""

ORACLES: dict[str, str] = {
    "op1_warc": f"""
WITH rows AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT page_id, url, strlen(payload) AS payload_bytes, {_DIGEST} AS payload_digest FROM rows),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests)
SELECT page_id, url, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, payload_bytes, payload_digest,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
""",
    "op6_url_filter": f"""
WITH rules(rule, r_host, r_path, said) AS (
    VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
           ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
           ('com/de/', 'com', '/de/', 'block')),
split AS (
    SELECT page_id, coalesce(url, '') AS url, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS host,
           regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 2) AS path
    FROM ({_HOST_PATH})),
lowered AS (
    SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM split),
numbered AS (SELECT *, row_number() OVER () AS n FROM lowered),
fits AS (
    SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said
    FROM numbered, rules
    WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    GROUP BY n)
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict
FROM numbered LEFT JOIN fits USING (n)
""",
    "op4_similar_documents": r"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
keyed AS (SELECT doc_id, w, array_to_string(w, ' ') AS k FROM words),
texts AS (
    SELECT k, any_value(w) AS w, min(doc_id) AS copy_of, count(*) AS copies FROM keyed WHERE len(w) > 0 GROUP BY k),
sets AS (
    SELECT copy_of AS id, copies,
           list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                              ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
    FROM texts),
tokens AS (SELECT id, len(s) AS n, unnest(s) AS t FROM sets),
shared AS (
    SELECT a.id AS x, b.id AS y, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m
    FROM tokens a JOIN tokens b ON a.t = b.t AND a.id <> b.id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared WHERE c >= 0.8 * (n + m - c) - 1e-9),
reach(x, y) AS (SELECT id, id FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
classes AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x),
degrees AS (SELECT x, sum(copies) AS d FROM links JOIN sets ON sets.id = links.y GROUP BY x)
SELECT keyed.doc_id, coalesce(class_id, keyed.doc_id) AS class_id, coalesce(copy_of, keyed.doc_id) AS copy_of,
       (coalesce(d, 0) + coalesce(copies - 1, 0))::BIGINT AS n_links
FROM keyed LEFT JOIN texts USING (k) LEFT JOIN classes ON classes.x = copy_of LEFT JOIN degrees ON degrees.x = copy_of
""",
    "op11_spelling_variants": r"""
WITH RECURSIVE
crc(t) AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{C0}-\x{FF}]{6,}')) AS run
    FROM documents),
counted AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, run, count(*) AS c FROM runs GROUP BY 1, 2),
bytes AS (
    SELECT run, c, flatten(list_transform(string_split(d || ':' || run, ''), lambda x:
        CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + ord(x) // 64, 128 + ord(x) % 64]::BIGINT[] END)) AS b
    FROM counted),
hashed AS (
    SELECT run, c, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], b),
        lambda h, x: xor(h // 256, t[xor(h, x) % 256 + 1]))) AS h
    FROM bytes, crc),
slipped AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c
    FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
less AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.k = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.k = b.word),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS o, max(other_n) AS o_n FROM near GROUP BY word),
forms AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN o_n >= 5 * n THEN o END AS form, CASE WHEN o_n >= 5 * n THEN o_n END AS form_n
    FROM words LEFT JOIN best ON best.word = words.word),
follow(word, reached, next) AS (
    SELECT word, word, form FROM forms
    UNION ALL SELECT follow.word, forms.word, forms.form FROM follow JOIN forms ON forms.word = follow.next)
SELECT forms.word, n, n_near, form, form_n, follow.reached AS root
FROM forms JOIN follow ON follow.word = forms.word AND follow.next IS NULL
""",
    "op13_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
    FROM words, range(1, 5) t(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30),
split AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
    SELECT lang, k, phrase, f, cut, array_to_string(w[1 : cut], ' ') AS head, array_to_string(w[cut + 1 : k], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM split)),
scores AS (
    SELECT cuts.lang, cuts.phrase, cuts.f AS a, x.f AS l, y.f AS r, cut, 2000000::HUGEINT * cuts.f // (x.f::HUGEINT + y.f) AS score
    FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = head JOIN counts y ON y.lang = cuts.lang AND y.phrase = tail),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scores),
inner_size AS (SELECT lang, k, w, f, unnest(range(2, k)) AS size FROM split WHERE k > 2),
inner_start AS (SELECT lang, k, w, f, size, unnest(range(1, k - size + 2)) AS start FROM inner_size),
covers AS (SELECT lang, array_to_string(w[start : start + size - 1], ' ') AS phrase, max(f) AS longer FROM inner_start GROUP BY 1, 2),
ranked AS (
    SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank
    FROM best LEFT JOIN covers ON covers.lang = best.lang AND covers.phrase = best.phrase
    WHERE nth = 1 AND NOT coalesce(100::HUGEINT * longer >= 80::HUGEINT * a, false))
SELECT ranked.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
""",
}
