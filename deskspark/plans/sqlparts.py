"""Reusable DuckDB SQL fragments for the oracle queries."""

from __future__ import annotations

from deskspark.config import DEFAULT
from deskspark.functions.text import clean_text_sql, unicode_re2


def md5_key(id_expr: str, salt: str) -> str:
    return f"md5(CAST({id_expr} AS VARCHAR) || '-{salt}')"


def prepared_ctes(topic: str = "lang", min_len: int = DEFAULT.min_text_length) -> str:
    """raw -> nn -> cl -> lf -> dd -> lab -> enc (prepared tickets)."""
    return f"""
raw AS (SELECT doc_id, text AS document, {topic} AS topic_group FROM documents),
nn AS (SELECT * FROM raw WHERE document IS NOT NULL AND topic_group IS NOT NULL),
cl AS (SELECT doc_id, document, topic_group, {clean_text_sql('document')} AS document_clean FROM nn),
lf AS (SELECT * FROM cl WHERE length(document_clean) >= {min_len}),
dd AS (SELECT * FROM lf QUALIFY row_number() OVER (PARTITION BY document_clean ORDER BY doc_id) = 1),
lab AS (SELECT CAST(dense_rank() OVER (ORDER BY topic_group) - 1 AS INTEGER) AS topic_encoded, topic_group
        FROM (SELECT DISTINCT CAST(topic_group AS VARCHAR) AS topic_group FROM dd)),
enc AS (SELECT dd.doc_id, dd.document, dd.topic_group, dd.document_clean, lab.topic_encoded
        FROM dd JOIN lab USING (topic_group))"""


def split_ctes(src: str = "enc", frac: str = DEFAULT.test_fraction, seed: int = DEFAULT.seed) -> str:
    """Adds ``sp``: ``src`` plus ``split`` ('test' / 'train')."""
    key = md5_key("doc_id", str(seed))
    return f"""
cnt AS (SELECT topic_encoded, CAST(count(*) AS BIGINT) AS n FROM {src} GROUP BY 1),
qa AS (SELECT topic_encoded, n, CAST(sum(n) OVER () AS BIGINT) AS tot,
              CAST(ceil(sum(n) OVER () * {frac}) AS BIGINT) AS nt, min(n) OVER () AS min_n FROM cnt),
qb AS (SELECT *, (n * nt) // tot AS base, (n * nt) % tot AS rem FROM qa),
qc AS (SELECT topic_encoded, nt, min_n,
              base + CASE WHEN row_number() OVER (ORDER BY rem DESC, topic_encoded)
                               <= nt - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM qb),
rk AS (SELECT s.*,
              row_number() OVER (PARTITION BY topic_encoded ORDER BY {key}, doc_id) AS r_strat,
              row_number() OVER (ORDER BY {key}, doc_id) AS r_all FROM {src} s),
sp AS (SELECT rk.* EXCLUDE (r_strat, r_all),
              CASE WHEN (CASE WHEN qc.min_n >= 2 THEN r_strat <= qc.quota ELSE r_all <= qc.nt END)
                   THEN 'test' ELSE 'train' END AS split
       FROM rk JOIN qc USING (topic_encoded))"""


def words_sql(x: str) -> str:
    run = unicode_re2(r"\s+")
    t = f"trim(regexp_replace({x}, '{run}', ' ', 'g'))"
    return f"(CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE string_split({t}, ' ') END)"


def raw_len_sql(x: str) -> str:
    return f"CAST(coalesce(length({x}), 3) AS BIGINT)"


def describe_sql(v: str) -> str:
    return (f"CAST(count({v}) AS BIGINT) AS count, round(avg({v}), 6) AS mean, "
            f"round(stddev_samp({v}), 6) AS std, round(CAST(min({v}) AS DOUBLE), 6) AS min, "
            f"round(quantile_cont({v}, 0.25), 6) AS q25, round(quantile_cont({v}, 0.5), 6) AS q50, "
            f"round(quantile_cont({v}, 0.75), 6) AS q75, round(CAST(max({v}) AS DOUBLE), 6) AS max")


def train_features_ctes() -> str:
    """``tf``: train split rows with the four text features."""
    w = words_sql("document_clean")
    return f"""
tr AS (SELECT * FROM sp WHERE split = 'train'),
tw AS (SELECT doc_id, topic_group, topic_encoded, document_clean, {w} AS w FROM tr),
tf AS (SELECT doc_id, topic_group, topic_encoded,
              CAST(len(w) AS BIGINT) AS word_count,
              CAST(length(document_clean) AS BIGINT) AS char_count,
              CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda x: length(x))) / len(w) ELSE 0.0 END
                AS avg_word_length,
              CAST(len(list_distinct(w)) AS BIGINT) AS unique_words,
              CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0.0 END AS unique_ratio
       FROM tw),
tl AS (SELECT topic_group, 'word_count' AS feature, CAST(word_count AS DOUBLE) AS v FROM tf
       UNION ALL SELECT topic_group, 'char_count', CAST(char_count AS DOUBLE) FROM tf
       UNION ALL SELECT topic_group, 'avg_word_length', CAST(avg_word_length AS DOUBLE) FROM tf
       UNION ALL SELECT topic_group, 'unique_ratio', CAST(unique_ratio AS DOUBLE) FROM tf)"""


# --- PII -------------------------------------------------------------------

def pii_count_cols(text: str) -> str:
    from deskspark.functions.pii import PII_PATTERNS

    return ", ".join(f"CAST(len(regexp_extract_all({text}, '{unicode_re2(p)}', 0, 'i')) AS BIGINT) AS c{i}"
                     for i, (_, p) in enumerate(PII_PATTERNS))


def pii_details_sql() -> str:
    from deskspark.functions.pii import PII_PATTERNS

    items = ", ".join(f"CASE WHEN c{i} > 0 THEN '{tag}: ' || c{i} || ' occurrence(s)' END"
                      for i, (tag, _) in enumerate(PII_PATTERNS))
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def pii_scrub_ctes(src: str, ids: str, text: str = "text") -> str:
    """``pc`` (counts + details) and ``ps`` (scrubbed text) over ``src``."""
    from deskspark.functions.pii import PII_PATTERNS

    parts = [f"pc AS (SELECT {ids}, {text} AS text, {pii_count_cols(text)} FROM {src})",
             f"pd AS (SELECT *, {pii_details_sql()} AS details FROM pc)",
             "s0 AS (SELECT *, text AS scrubbed FROM pd)"]
    for i, (tag, p) in enumerate(PII_PATTERNS):
        parts.append(f"s{i + 1} AS (SELECT * REPLACE (CASE WHEN c{i} > 0 THEN regexp_replace(scrubbed, '{unicode_re2(p)}', "
                     f"'{tag}', 'gi') ELSE scrubbed END AS scrubbed) FROM s{i})")
    parts.append(f"ps AS (SELECT * FROM s{len(PII_PATTERNS)})")
    return ",\n".join(parts)


# --- naive Bayes language id ----------------------------------------------

NON_LETTERS = r"[^a-z\x{00df}-\x{00ff}]+"


def nb_ctes(train_src: str, target_src: str, ids: str, alpha: float = 1.0) -> str:
    """``train_src(label, text)``, ``target_src(<ids>, text)`` -> ``nbp(<ids>, language)``."""
    norm = f"' ' || regexp_replace(lower(text), '{NON_LETTERS}', ' ', 'g') || ' '"
    on = " AND ".join(f"nv.{c.strip()} = ms.{c.strip()}" for c in ids.split(","))
    return f"""
nbt AS (SELECT label, {norm} AS t FROM {train_src}),
nbg AS (SELECT label, substring(t, i, 3) AS gram FROM (SELECT label, t, unnest(range(1, length(t) - 1)) AS i FROM nbt)),
nbc AS (SELECT gram, label, count(*) AS c FROM nbg GROUP BY ALL),
nbl AS (SELECT p.label, ln(p.n_docs / sum(p.n_docs) OVER ()) AS lp,
               ln(coalesce(t.t, 0) + {alpha} * (SELECT count(DISTINCT gram) FROM nbc)) AS ld
        FROM (SELECT label, count(*) AS n_docs FROM nbt GROUP BY 1) p
        LEFT JOIN (SELECT label, sum(c) AS t FROM nbc GROUP BY 1) t USING (label)),
nbx AS (SELECT {ids}, {norm} AS t FROM {target_src}),
nbd AS (SELECT {ids}, substring(t, i, 3) AS gram FROM (SELECT {ids}, t, unnest(range(1, length(t) - 1)) AS i FROM nbx)),
nbv AS (SELECT {ids}, count(*) AS nvc FROM nbd WHERE gram IN (SELECT gram FROM nbc) GROUP BY ALL),
nbm AS (SELECT {ids}, nbc.label, sum(ln(nbc.c + {alpha}) - ln({alpha})) AS s FROM nbd JOIN nbc USING (gram) GROUP BY ALL),
nbs AS (SELECT nv.*, l.label, coalesce(ms.s, 0) + nv.nvc * (ln({alpha}) - l.ld) + l.lp AS score
        FROM nbv nv CROSS JOIN nbl l LEFT JOIN nbm ms ON {on} AND ms.label = l.label),
nbb AS (SELECT {ids}, label AS language FROM nbs
        QUALIFY row_number() OVER (PARTITION BY {ids} ORDER BY score DESC, label) = 1),
nbp AS (SELECT {", ".join("x." + c.strip() for c in ids.split(","))}, coalesce(b.language, 'unknown') AS language
        FROM nbx x LEFT JOIN nbb b USING ({ids}))"""
