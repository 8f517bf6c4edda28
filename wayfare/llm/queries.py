"""Registry of the training-data queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op9_byte_bpe
from .contamination import op11_prefix_join
from .fingerprints import op8_one_permutation
from .jaccard import op3_heavy_light
from .lexical import op12_impact_ordered
from .mixing import op5_curriculum
from .periods import op13_bit_lags
from .sharding import op4_hash_tree
from .substring import op10_count_min
from .suffixes import op1_suffix_array
from .tiff import op2_tiff
from .toxicity import op7_crf
from .wordpiece import op6_longest_match

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array": op1_suffix_array,
    "op2_tiff": op2_tiff,
    "op3_heavy_light": op3_heavy_light,
    "op4_hash_tree": op4_hash_tree,
    "op5_curriculum": op5_curriculum,
    "op6_longest_match": op6_longest_match,
    "op7_crf": op7_crf,
    "op8_one_permutation": op8_one_permutation,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_count_min": op10_count_min,
    "op11_prefix_join": op11_prefix_join,
    "op12_impact_ordered": op12_impact_ordered,
    "op13_bit_lags": op13_bit_lags,
}

#: A-Z in lower case and nothing else.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_SPACED = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE_SQL: dict[str, str] = {
    "op3_heavy_light": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_SPACED.format(_LOWER)} AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, w[k : k + 2] AS s
            FROM (SELECT doc_id, w, unnest(range(1, 1 + CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 2, 1) END)) AS k FROM d)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS MATERIALIZED (SELECT x, y FROM common c JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c.n >= 90 * (a.n + b.n - c.n)),
        edges AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached AS (SELECT x AS doc_id, x AS other FROM edges UNION SELECT r.doc_id, b.y FROM reached r JOIN edges b ON r.other = b.x)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(component, d.doc_id), d.doc_id) AS component_id
        FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id) USING (doc_id)""",
    "op10_count_min": f"""
        WITH d AS (SELECT doc_id, {_SPACED.format("text")} AS w FROM documents),
        windows AS (SELECT doc_id, p, w[p : p + 19] AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS p FROM d)),
        late AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM late),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
        counts AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op11_prefix_join": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, w[k : k + 9] AS words
            FROM (SELECT item_id, w, unnest(range(1, 1 + CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 9, 1) END)) AS k FROM i)
        ),
        places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
        hits AS (
            SELECT doc_id, p, len(words) AS n, item_id
            FROM places CROSS JOIN (SELECT DISTINCT len(words) AS n FROM windows) AS sizes JOIN windows ON words = w[p : p + n - 1]
        ),
        covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS k FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op12_impact_ordered": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
        asked AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
        tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
        weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, docs),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
            FROM asked JOIN tf USING (term) JOIN weight USING (term), s GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10""",
}
