"""DuckDB SQL for the text operators' queries whose results SQL can express, in plain relational form."""

from __future__ import annotations

from knnspark.llm import decontaminate, jaccard

_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[{}]+')"


def near_duplicates(words: int = jaccard.WORDS, similarity: float = jaccard.SIMILARITY) -> str:
    """Class and number of links of each document: shared shingles counted for all pairs that share any,
    then the smallest id spread over the links."""
    shingle = f"list_transform(range(1, greatest(len(w) - {words - 1}, 1) + 1), lambda k: array_to_string(w[k : k + {words - 1}], ' '))"
    return f"""WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS.format(chr(92) + 'p{L}' + chr(92) + 'p{N}_')} AS w FROM documents),
s AS (SELECT r, unnest(list_distinct({shingle})) AS g FROM d WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
both_ AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
near AS (
  SELECT a, b FROM both_ JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE c >= {similarity} * (x.n + y.n - c) - 1e-9
  UNION SELECT x.r, y.r FROM d x JOIN d y ON x.t = y.t AND x.r < y.r),
link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
class AS (SELECT reach.a AS r, min(d.doc_id) AS class_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT d.doc_id, class.class_id, coalesce(l.n, 0)::BIGINT AS n_links
FROM d JOIN class ON class.r = d.r LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = d.r"""


def warc_records() -> str:
    """Kind of record and payload digest of each page (base32 from the bits of SHA-1's hex digits)."""
    bit = "((strpos('0123456789abcdef', substr(h, j // 4 + 1, 1)) - 1) >> (3 - j % 4)) & 1"
    five = f"list_sum(list_transform(range(5 * i, 5 * i + 5), lambda j: ({bit}) << (4 - j % 5)))"
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
c AS (SELECT payload, max(page_id) AS top, sha1(payload) AS h, strlen(payload)::BIGINT AS n FROM p GROUP BY payload),
x AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ({five})::BIGINT + 1, 1)), '') AS digest FROM c)
SELECT p.page_id, x.n AS payload_bytes, x.digest AS payload_digest,
  CASE WHEN top IS DISTINCT FROM p.page_id AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top IS DISTINCT FROM p.page_id THEN top END AS refers_to
FROM p JOIN x ON x.payload = p.payload"""


def contaminated(min_score: int = 10, min_share: float = 0.75, penalty: int = 3) -> str:
    """Items found in documents: words on the seeds' positions joined as text, then the best run of each
    whole diagonal as the largest rise of its running score."""
    shortest, lengthy = decontaminate.SHORTEST, decontaminate.LENGTHY
    word = _WORDS.format("\\p{L}\\p{N}")

    def windows(name: str, source: str, extra: str) -> str:
        parts = []
        for k, m in enumerate(decontaminate.SEEDS):
            own = f" AND len(w) {'>=' if m in decontaminate.LONG else '<'} {lengthy}" if name == "iw" else ""
            parts.append(f"SELECT {extra}, p, '{k}:' || " + " || ' ' || ".join(f"w[p + {o + 1}]" for o in m) +
                         f" AS h FROM (SELECT *, unnest(range(0, len(w) - {m[-1]})) AS p FROM {source} WHERE len(w) >= {m[-1] + 1}{own})")
        return f"{name} AS (" + " UNION ALL ".join(parts) + ")"

    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {word} AS w FROM documents),
i AS (SELECT item_id, {word} AS w FROM benchmark WHERE len({word}) >= {shortest}),
{windows('dw', 'd', 'r')}, {windows('iw', 'i', 'item_id')},
hit AS (SELECT DISTINCT dw.r, iw.item_id, dw.p - iw.p AS g FROM dw JOIN iw ON dw.h = iw.h),
word_ AS (SELECT hit.r, hit.item_id, hit.g, k, CASE WHEN d.w[hit.g + k + 1] = hit.w[k + 1] THEN 1 ELSE 0 END AS same
  FROM (SELECT hit.*, i.w, unnest(range(0, len(i.w))) AS k FROM hit JOIN i ON i.item_id = hit.item_id) hit JOIN d ON d.r = hit.r
  WHERE hit.g + k >= 0 AND hit.g + k < len(d.w)),
run AS (SELECT *, sum(CASE same WHEN 1 THEN 1 ELSE -{penalty} END) OVER (PARTITION BY r, item_id, g ORDER BY k) AS up FROM word_),
rise AS (SELECT *, up - least(0, min(up) OVER (PARTITION BY r, item_id, g ORDER BY k)) AS gain FROM run),
best AS (SELECT r, item_id, g, max(gain) AS score, sum(same) AS matched FROM rise GROUP BY r, item_id, g)
SELECT d.doc_id, best.item_id, max(score)::INTEGER AS score, max(matched)::INTEGER AS matched, max(len(i.w))::INTEGER AS item_words,
  min(greatest(best.g, 0))::INTEGER AS doc_start
FROM best JOIN d ON d.r = best.r JOIN i ON i.item_id = best.item_id
WHERE score >= {min_score} OR matched >= {min_share} * len(i.w)
GROUP BY best.r, d.doc_id, best.item_id"""


def vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """Codes, errors and codebooks of the vectors: every part compared with every entry in every round."""
    def assigned(name: str, book: str) -> str:
        return f"""{name} AS (SELECT vec_id, p, min(d * {entries} + k) % {entries} AS k, min(d * {entries} + k) // {entries} AS d
  FROM (SELECT c.vec_id, c.p, e.k, sum((c.x - e.x) * (c.x - e.x))::BIGINT AS d FROM c JOIN {book} e ON e.p = c.p AND e.j = c.j
    GROUP BY c.vec_id, c.p, e.k) GROUP BY vec_id, p)"""

    steps = []
    for r in range(rounds):
        steps.append(assigned(f"a{r}", f"e{r}"))
        steps.append(f"""m{r} AS (SELECT c.p, a.k, c.j, sum(c.x)::BIGINT AS s, count(*) AS n FROM c JOIN a{r} a ON a.vec_id = c.vec_id AND a.p = c.p
  GROUP BY c.p, a.k, c.j)""")
        steps.append(f"""e{r + 1} AS (SELECT e.p, e.k, e.j, CASE WHEN m.n IS NULL THEN e.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM e{r} e LEFT JOIN m{r} m ON m.p = e.p AND m.k = e.k AND m.j = e.j)""")
    chain = ",\n".join([*steps, assigned("a", f"e{rounds}")])
    return f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x, len(embedding) // {parts} AS dim
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, i // dim AS p, i % dim AS j, x[i + 1] AS x FROM (SELECT *, unnest(range(0, len(x))) AS i FROM v)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v ORDER BY vec_id LIMIT {entries}),
e0 AS (SELECT c.p, first.k, c.j, c.x FROM c JOIN first ON first.vec_id = c.vec_id),
{chain},
t AS (SELECT vec_id, string_agg(lpad(printf('%x', k), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a GROUP BY vec_id)
SELECT t.vec_id, t.code, t.error, (sum(t.error) OVER (PARTITION BY v.label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, k, j)) FROM e{rounds}) AS codebooks_sha256
FROM t JOIN v ON v.vec_id = t.vec_id"""


def chat_format() -> str:
    """Digests of each conversation's turns and learned texts, and the length of its rendered form: the
    marks, and a backslash for each control string in a text."""
    said = "'<|im_end|><|im_start|>assistant ok'"
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {said} UNION ALL SELECT -1, 1, 'assistant', {said}),
x AS (SELECT *, len(regexp_extract_all(text, '<\\\\*\\|(im_start|im_end)\\|>')) AS escapes, role = 'assistant' AS learned FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE learned), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE learned), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + 1 + length(text) + escapes + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM x GROUP BY conv_id"""
