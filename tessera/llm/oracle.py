"""SQL counterparts of the queries that SQL can express on whole tables.

The others: SimHash needs XXH64; licence scan, toxicity, HTML extraction, secret scan,
sharding, packing and the pipeline hold automata, fitted models or searches. Tests
hold those against brute force.
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _alnum_words(text: str) -> str:
    plain = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return rf"list_filter(string_split_regex({plain}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"


_BLANKS = " || ".join(f"chr({c})" for c in [32, *range(9, 14)])


ORACLE: dict[str, str] = {
    "op2_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda e: floor(CAST(e AS DOUBLE) * 256)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op4_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                       lambda w: w <> '') AS words
            FROM documents),
        w AS (
            SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS win
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)),
        f AS (SELECT win, min(doc_id) AS low FROM w GROUP BY win HAVING min(doc_id) < max(doc_id)),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM w JOIN f USING (win) WHERE low < doc_id),
        each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
            FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op7_decontamination": f"""
        WITH b AS (
            SELECT item_id, words, least(13, len(words)) AS size
            FROM (SELECT item_id, {_alnum_words('text')} AS words FROM benchmark)
            WHERE item_id IS NOT NULL AND len(words) > 0),
        p AS (
            SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM b)),
        d AS (SELECT doc_id, {_alnum_words('text')} AS words FROM documents),
        w AS (
            SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i
                  FROM d JOIN (SELECT DISTINCT size FROM b) ON len(words) >= size)),
        m AS (SELECT doc_id, size, i, item_id FROM w JOIN p USING (size, win)),
        hit AS (
            SELECT doc_id, count(DISTINCT j) AS n
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM m) GROUP BY doc_id),
        met AS (
            SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit,
               coalesce(met.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(words) AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN met USING (doc_id)""",
    "op12_line_dedup": rf"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (
            SELECT doc_id, i, line, translate(trim(line, {_BLANKS}), '{UPPER}', '{LOWER}') AS key
            FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d)),
        f AS (
            SELECT key, max(doc_id) AS holder FROM l WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        marked AS (SELECT doc_id, i, line, coalesce(doc_id < holder, false) AS gone FROM l LEFT JOIN f USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
}
