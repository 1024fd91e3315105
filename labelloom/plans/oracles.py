"""The catalogue's queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

import string

from labelloom.plans.catalogue import BAD, GOOD, PERCENTILE, TEST_LICENSES


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_quote(v) for v in values)


# Code points that count as white space at the ends of a text, and characters with an id, spelled out here on purpose.
SPACE_POINTS = (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
WS = "(" + " || ".join(f"chr({c})" for c in SPACE_POINTS) + ")"
ALPHABET = string.ascii_lowercase + string.digits + string.punctuation + " \n\t"
PERMITTED = _list(TEST_LICENSES.permitted_names)
MAPPED = _list(TEST_LICENSES.mapped_names)
DIMENSION = "(VALUES {}) AS dim(source, source_dataset, source_license, upstream_url)".format(
    ", ".join(
        f"({_list((p.source, p.source_dataset, p.source_license, p.upstream_url))})"
        for p in TEST_LICENSES.permitted
    )
)

CORPUS = (
    "corpus AS (SELECT doc_id, text, CAST(doc_id % 2 AS INTEGER) AS label, source, lang FROM documents)"
)
LABELLED = (
    "labelled AS (SELECT doc_id, d.text, d.source, d.lang, l.toxic AS label "
    "FROM documents d JOIN labels l USING (doc_id))"
)
PADS = "[chr(160), chr(9), chr(10), chr(28), '']"
DIRTY = f"""dirty AS (SELECT doc_id,
    CASE WHEN doc_id % 17 = 0 THEN {PADS}[doc_id % 5 + 1] WHEN doc_id % 17 = 1 THEN NULL
         ELSE {PADS}[doc_id % 5 + 1] || text || {PADS}[doc_id % 5 + 1] END AS essay,
    [{_list(GOOD)}][doc_id % {len(GOOD)} + 1] AS spelled,
    source FROM documents)"""


def _parse(raw: str) -> str:
    word = f"lower(trim({raw}, {WS}))"
    number = f"TRY_CAST({word} AS DOUBLE)"
    return (
        f"CASE WHEN {word} IN ('1','true','generated','ai','llm','machine') THEN 1 "
        f"WHEN {word} IN ('0','false','human','student','real') THEN 0 "
        f"WHEN regexp_full_match({word}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?') "
        f"AND {number} > -1 AND {number} < 2 THEN CAST(trunc({number}) AS INTEGER) END"
    )


# Within one (text, label) the first row is the one with the least doc_id; across labels a
# text is dropped. What is left per text has one label, and its smallest source is kept.
UNIQUE = (
    CORPUS
    + """, firsts AS (SELECT text, label, arg_min(source, doc_id) AS source FROM corpus GROUP BY text, label),
    uniq AS (SELECT text, min(label) AS label, min(source) AS source FROM firsts
    GROUP BY text HAVING min(label) = max(label))"""
)


def _key(purpose: str, seed: str = "'42'") -> str:
    return f"md5(concat({seed}, ':{purpose}:', md5(text)))"


def _three_way(rows: str, fraction: float = 0.1) -> str:
    """CTEs ``sizes`` and ``assigned`` over a table with text and label."""
    return f"""sizes AS (SELECT label, n,
        CASE WHEN t + v >= n THEN greatest(1, least(t, n - 2)) ELSE t END AS test, v, t
        FROM (SELECT label, count(*) AS n,
            greatest(1, CAST(round_even(count(*) * {fraction}, 0) AS BIGINT)) AS t,
            greatest(1, CAST(round_even(count(*) * {fraction}, 0) AS BIGINT)) AS v
            FROM {rows} GROUP BY label)),
    cut AS (SELECT label, test,
        CASE WHEN t + v >= n THEN greatest(1, least(v, n - test - 1)) ELSE v END AS val FROM sizes),
    assigned AS (SELECT r.*, CASE WHEN rn <= test THEN 'test' WHEN rn <= test + val THEN 'val'
        ELSE 'train' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_key('split')}) AS rn FROM {rows}) r
        JOIN cut USING (label))"""


def _two_way(rows: str, fraction: float = 0.2) -> str:
    return f"""cut AS (SELECT label,
        greatest(1, least(CAST(round_even(count(*) * {fraction}, 0) AS BIGINT), count(*) - 1)) AS val
        FROM {rows} GROUP BY label),
    assigned AS (SELECT r.*, CASE WHEN rn <= val THEN 'val' ELSE 'train' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_key('split')}) AS rn FROM {rows}) r
        JOIN cut USING (label))"""


def _balanced(rows: str, cap: str, purpose: str = "sample") -> str:
    """CTE ``sampled`` over a table with text and label of both kinds."""
    return f"""cap AS (SELECT {cap} AS m, count(*) FILTER (label = 0) AS n0,
        count(*) FILTER (label = 1) AS n1 FROM {rows}),
    quota AS (SELECT 0 AS label, least(n0, m - least(n1, m - m // 2)) AS k FROM cap
        UNION ALL SELECT 1, least(n1, m - least(n0, m // 2)) FROM cap),
    sampled AS (SELECT r.* FROM (SELECT *,
        row_number() OVER (PARTITION BY label ORDER BY {_key(purpose)}) AS rn FROM {rows}) r
        JOIN quota USING (label) WHERE rn <= k)"""


TWO_SOURCES = (
    CORPUS
    + ", "
    + LABELLED
    + """, both_sources AS (
    SELECT text, label, 'a' AS source_dataset, source, NULL AS lang, 0 AS ordinal FROM corpus
    UNION ALL SELECT text, label, 'b', NULL, lang, 1 FROM labelled)"""
)

PRESPLIT = """presplit AS (SELECT DISTINCT text, CAST((doc_id // 10) % 2 AS INTEGER) AS label,
    CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'val' ELSE 'test' END AS split
    FROM documents)"""
ALLOCATION = """sized AS (SELECT split, count(*) AS size,
        CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END AS ord FROM presplit GROUP BY split),
    shared AS (SELECT *, (sum(size) OVER ()) // 2 AS wanted,
        CAST((sum(size) OVER ()) // 2 * size AS DOUBLE) / CAST(sum(size) OVER () AS DOUBLE) AS share FROM sized),
    floored AS (SELECT *, greatest(2, CAST(floor(share) AS BIGINT)) AS base FROM shared),
    allocation AS (SELECT split, size, CAST(base + CASE WHEN row_number() OVER
        (ORDER BY share - base DESC, size DESC, ord) <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT)
        AS sample_rows, ord FROM floored)"""
PRESPLIT_SAMPLE = f"""counts AS (SELECT split, label, count(*) AS n FROM presplit GROUP BY split, label),
    quota AS (SELECT a.split, c.label, least(c.n, sample_rows - least(o.n, CASE WHEN c.label = 1
        THEN sample_rows // 2 ELSE sample_rows - sample_rows // 2 END)) AS k
        FROM allocation a JOIN counts c USING (split)
        JOIN counts o ON o.split = a.split AND o.label = 1 - c.label),
    sampled AS (SELECT r.* FROM (SELECT *, row_number() OVER (PARTITION BY split, label ORDER BY
        {_key('sample', "CASE split WHEN 'train' THEN '42' WHEN 'val' THEN '43' ELSE '44' END")}) AS rn
        FROM presplit) r JOIN quota q ON q.split = r.split AND q.label = r.label WHERE rn <= k)"""

SCORED = (
    LABELLED
    + """, scored AS (SELECT doc_id, label, source, lang,
    CAST((CAST(concat('0x', substr(md5(CAST(doc_id AS VARCHAR)), 1, 6)) AS BIGINT) % 101) + 20 * label
        AS DOUBLE) / 120 AS score FROM labelled)"""
)


def _curve(by: str = "") -> str:
    """CTE ``curve``: running confusion counts per distinct score of ``rows``."""
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""tied AS (SELECT {group}score, sum(label) AS p, sum(1 - label) AS q FROM rows
        GROUP BY {group}score),
    curve AS (SELECT {group}score, p, q,
        sum(p) OVER ({part}ORDER BY score DESC) AS tp, sum(q) OVER ({part}ORDER BY score DESC) AS fp,
        {f"sum(p) OVER ({part.strip()})" if by else "sum(p) OVER ()"} AS pos,
        {f"sum(q) OVER ({part.strip()})" if by else "sum(q) OVER ()"} AS neg FROM tied)"""


ROC = """CASE WHEN max(pos) > 0 AND max(neg) > 0 THEN CAST(sum(q * (2 * (tp - p) + p)) AS DOUBLE)
    / (2 * CAST(max(pos) AS DOUBLE) * CAST(max(neg) AS DOUBLE)) END"""
PR = """CASE WHEN max(pos) > 0 THEN sum(CAST(p AS DOUBLE) * tp / (tp + fp)) / CAST(max(pos) AS DOUBLE) END"""
BRIER = "sum(p * (score - 1) * (score - 1) + q * score * score) / CAST(sum(p + q) AS DOUBLE)"


def _report(by: tuple[str, ...] = (), threshold: float | None = None, rows="SELECT * FROM scored") -> str:
    keys = ", ".join(by)
    cols = f"{keys}, " if by else ""
    group = f"GROUP BY {keys}" if by else ""
    part = f"PARTITION BY {keys} " if by else ""
    fixed = 0.5 if threshold is None else threshold
    sweep = (
        f"SELECT {cols}score AS t, tp, fp, pos, neg, 0 AS appended FROM curve UNION ALL "
        if threshold is None
        else ""
    )
    using = f"USING ({keys})" if by else "ON TRUE"
    return f"""rows AS ({rows}), {_curve(keys)},
    ranking AS (SELECT {cols}{ROC} AS roc_auc, {PR} AS pr_auc, {BRIER} AS brier_score FROM curve {group}),
    candidates AS ({sweep}SELECT {cols}CAST({fixed} AS DOUBLE) AS t,
        coalesce(sum(p) FILTER (score >= {fixed}), 0) AS tp,
        coalesce(sum(q) FILTER (score >= {fixed}), 0) AS fp,
        max(pos) AS pos, max(neg) AS neg, 1 AS appended FROM curve {group}),
    pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS p,
        CASE WHEN pos > 0 THEN CAST(tp AS DOUBLE) / pos ELSE 0 END AS r FROM candidates),
    f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pr),
    best AS (SELECT * FROM (SELECT *, row_number() OVER
        ({part}ORDER BY f1 DESC, p DESC, r DESC, appended, t) AS place FROM f) WHERE place = 1),
    report AS (SELECT {cols}round(roc_auc, 9) AS roc_auc, round(pr_auc, 9) AS pr_auc,
        round(brier_score, 9) AS brier_score, round(t, 9) AS threshold, round(p, 9) AS precision,
        round(r, 9) AS recall, round(f1, 9) AS f1,
        CAST(tp AS BIGINT) AS true_positive, CAST(fp AS BIGINT) AS false_positive,
        CAST(neg - fp AS BIGINT) AS true_negative, CAST(pos - tp AS BIGINT) AS false_negative
        FROM best JOIN ranking {using})"""


LOGITS = "logits AS (SELECT *, score * 6 - 3 AS logit, CAST(doc_id % 5 + 1 AS INTEGER) AS epoch FROM scored)"
LOSS = "avg(greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit))))"
EPOCH_LOSS = """batches AS (SELECT epoch, source, avg(abs(score - label)) AS loss, count(*) AS n
    FROM logits GROUP BY epoch, source),
    epoch_loss AS (SELECT epoch, round(sum(loss * n) / sum(n), 9) AS loss FROM batches GROUP BY epoch)"""
HISTORY = f"""{SCORED}, {LOGITS}, {EPOCH_LOSS},
    {_report(("epoch",), rows="SELECT epoch, label, score FROM logits")},
    val AS (SELECT epoch, round({LOSS}, 9) AS val_loss FROM logits GROUP BY epoch),
    history AS (SELECT epoch, loss AS train_loss, val_loss, report.* EXCLUDE (epoch)
        FROM epoch_loss JOIN val USING (epoch) JOIN report USING (epoch))"""


def _unpivot(table: str, ids: str, metrics: tuple[str, ...], tag: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, {tag}'{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {table} WHERE {m} IS NOT NULL"
        for m in metrics
    )


SERIES = " UNION ALL ".join(
    _unpivot("history", f"'{name}' AS series, epoch", ms)
    for name, ms in (
        ("loss", ("train_loss", "val_loss")),
        ("ranking", ("roc_auc", "pr_auc")),
        ("threshold", ("precision", "recall", "f1")),
    )
)
LOGGED = (
    "roc_auc", "pr_auc", "brier_score", "threshold", "precision", "recall", "f1",
    "true_positive", "false_positive", "true_negative", "false_negative",
)
BOARD = _unpivot("report", "lang, source", ("roc_auc", "pr_auc", "f1", "precision", "recall", "brier_score"))

P95 = f"""CAST(greatest(0, least(n - 1, round_even((n - 1) * CAST({PERCENTILE} AS DOUBLE), 0))) AS BIGINT) + 1"""

CHAR_IDS = ", ".join(f"{ord(c)}: {i + 2}" for i, c in enumerate(ALPHABET))
CHAR_MAP = f"MAP {{{CHAR_IDS}}}"

MIRROR_STANDARD = (
    "text, label, '{d}' AS source_dataset, '{d}' AS source_detail, '{lic}' AS source_license, "
    "'' AS upstream_url, split"
)
LENGTH_MODEL = "1.0 / (1.0 + exp(-(length(text) - 1000) / 500.0))"

MULTI = f"""{CORPUS},
    docs AS (SELECT text, label, min(source) AS source FROM corpus WHERE source IN ({PERMITTED})
        GROUP BY text, label),
    turns AS (SELECT trim(text, {WS}) AS text, CAST(role = 'assistant' AS INTEGER) AS label
        FROM conversations WHERE length(trim(text, {WS})) > 0 GROUP BY ALL),
    every AS (SELECT text, label, dim.source_dataset, source AS source_detail, dim.source_license,
            dim.upstream_url, 0 AS ordinal FROM docs JOIN {DIMENSION} USING (source)
        UNION ALL SELECT text, label, 'turns', '', '', '', 1 FROM turns),
    clean AS (SELECT text, arg_min(label, ordinal) AS label, arg_min(source_dataset, ordinal) AS source_dataset,
        arg_min(source_detail, ordinal) AS source_detail, arg_min(source_license, ordinal) AS source_license,
        arg_min(upstream_url, ordinal) AS upstream_url FROM every GROUP BY text
        HAVING min(label) = max(label)),
    {_three_way('clean')}"""

PUBLISH = f"""{CORPUS}, wanted AS (SELECT count(*) // 2 AS human, greatest(0, count(*) // 2 -
        (SELECT count(*) FILTER (role = 'assistant' AND length(trim(text, {WS})) > 0) FROM conversations))
        AS generated FROM corpus),
    streamed AS (SELECT text, label FROM (SELECT text, label,
        row_number() OVER (PARTITION BY label ORDER BY {_key('stream')}) AS rn FROM corpus), wanted
        WHERE rn <= CASE WHEN label = 0 THEN human ELSE generated END),
    every AS (SELECT text, label, 'published' AS source, 'published' AS detail, 0 AS ordinal FROM streamed
        UNION ALL SELECT trim(text, {WS}), CAST(role = 'assistant' AS INTEGER), 'turns', role, 1
        FROM conversations WHERE length(trim(text, {WS})) > 0),
    clean AS (SELECT text, min(label) AS label, arg_min(source, (ordinal, detail)) AS source_dataset,
        arg_min(detail, (ordinal, detail)) AS source_detail FROM every GROUP BY text
        HAVING min(label) = max(label)),
    {_three_way('clean')}"""

ORACLES: dict[str, str] = {
    "normalize_corpus": f"""WITH {DIRTY}, clean AS (SELECT doc_id, trim(coalesce(essay, ''), {WS}) AS text,
        {_parse('spelled')} AS label, source FROM dirty)
        SELECT text, label, arg_min(source, doc_id) AS source FROM clean WHERE length(text) > 0
        GROUP BY text, label""",
    "text_strip": f"WITH {DIRTY} SELECT doc_id, trim(coalesce(essay, ''), {WS}) AS text FROM dirty",
    "label_parse": f"""WITH raws AS (SELECT doc_id, [{_list(GOOD + BAD)}][doc_id % {len(GOOD + BAD)} + 1] AS raw
        FROM documents) SELECT doc_id, raw, {_parse('raw')} AS label FROM raws""",
    "label_parse_numeric": """WITH raws AS (SELECT doc_id, (doc_id % 7 - 2) / 2.0 AS raw FROM documents)
        SELECT doc_id, CAST(raw AS DOUBLE) AS raw,
        CASE WHEN raw > -1 AND raw < 2 THEN CAST(trunc(raw) AS INTEGER) END AS label FROM raws""",
    "map_row_keys": """SELECT doc_id, text, CASE WHEN doc_id % 3 = 2 THEN 1
        ELSE CAST(doc_id % 2 AS INTEGER) END AS label FROM documents""",
    "default_provenance": f"""WITH {CORPUS} SELECT doc_id, text, label, 'name' AS source_dataset,
        CASE WHEN doc_id % 4 = 0 THEN source ELSE '' END AS source_detail, 'mit' AS source_license,
        '' AS upstream_url FROM corpus""",
    "standard_projection": f"""WITH {CORPUS} SELECT text, label, '' AS source_dataset, source AS source_detail,
        '' AS source_license, '' AS upstream_url, doc_id FROM corpus""",
    "license_filter": f"SELECT doc_id, source FROM documents WHERE source IN ({PERMITTED})",
    "license_enrich": f"""SELECT doc_id, source AS source_detail, dim.source_dataset, dim.source_license,
        dim.upstream_url FROM documents JOIN {DIMENSION} USING (source)""",
    "license_gate_off": f"WITH {CORPUS} SELECT doc_id, label, lang FROM corpus",
    "license_counts": f"""SELECT source, source IN ({PERMITTED}) AS permitted, count(*) AS rows
        FROM documents GROUP BY source""",
    "license_totals": f"""SELECT count(*) AS rows_before, count(*) FILTER (source IN ({PERMITTED})) AS rows_after,
        count(*) FILTER (source NOT IN ({PERMITTED})) AS rows_removed FROM documents""",
    "source_license_counts": f"""SELECT source AS source_detail, dim.source_license, count(*) AS rows
        FROM documents JOIN {DIMENSION} USING (source) GROUP BY ALL""",
    "union_sources": f"WITH {TWO_SOURCES} SELECT * FROM both_sources",
    "conflict_removal": f"""WITH {CORPUS} SELECT doc_id, label, text FROM corpus WHERE text NOT IN
        (SELECT text FROM corpus GROUP BY text HAVING min(label) <> max(label))""",
    "cross_source_dedup": f"""WITH {TWO_SOURCES}, firsts AS (SELECT *, row_number() OVER (PARTITION BY text
        ORDER BY ordinal, label, source_dataset, source NULLS FIRST, lang NULLS FIRST) AS rn,
        min(label) OVER (PARTITION BY text) AS lo, max(label) OVER (PARTITION BY text) AS hi FROM both_sources)
        SELECT text, label, source_dataset, source, lang FROM firsts WHERE rn = 1 AND lo = hi""",
    "dedup_counters": f"""WITH {TWO_SOURCES}, per_text AS (SELECT text, count(*) AS n,
        min(label) <> max(label) AS conflict FROM both_sources GROUP BY text)
        SELECT CAST(sum(n) AS BIGINT) AS rows_before_cross_source_deduplication,
        CAST(sum(CASE WHEN conflict THEN n ELSE 0 END) AS BIGINT) AS rows_with_conflicting_labels_removed,
        CAST(sum(CASE WHEN conflict THEN 0 ELSE n - 1 END) AS BIGINT) AS duplicate_text_rows_removed
        FROM per_text""",
    "split_leakage": f"""WITH {PRESPLIT} SELECT count(*) AS leaked_texts,
        CAST(coalesce(sum(n), 0) AS BIGINT) AS leaked_rows FROM (SELECT text, count(*) AS n FROM presplit
        GROUP BY text HAVING count(DISTINCT split) > 1)""",
    "seeded_shuffle": f"SELECT doc_id, {_key('shuffle')} AS order_key FROM documents",
    "balanced_sample": f"""WITH {UNIQUE}, {_balanced('uniq', 'count(*) // 2')}
        SELECT text, label, source FROM sampled""",
    "balanced_sample_backfill": f"""WITH {LABELLED}, uniq AS (SELECT text, label,
        arg_min(source, doc_id) AS source FROM labelled GROUP BY text, label),
        {_balanced('uniq', 'count(*) * 4 // 5')} SELECT text, label, source FROM sampled""",
    "balanced_sample_copies": f"""WITH {CORPUS}, {_balanced('corpus', 'count(*) // 2')}
        SELECT text, label FROM sampled""",
    "presplit_allocation": f"WITH {PRESPLIT}, {ALLOCATION} SELECT split, sample_rows FROM allocation",
    "presplit_sample": f"""WITH {PRESPLIT}, {ALLOCATION}, {PRESPLIT_SAMPLE}
        SELECT text, label, split FROM sampled""",
    "stratified_split_2way": f"""WITH {UNIQUE}, {_two_way('uniq')}
        SELECT text, label, source, split FROM assigned""",
    "stratified_split_3way": f"""WITH {UNIQUE}, {_three_way('uniq')}
        SELECT text, label, source, split FROM assigned""",
    "split_label_counts": f"""WITH {UNIQUE}, {_three_way('uniq')}
        SELECT split, label, count(*) AS rows FROM assigned GROUP BY ROLLUP (split, label)""",
    "label_counts": f"WITH {LABELLED} SELECT label, count(*) AS rows FROM labelled GROUP BY label",
    "roc_auc": f"""WITH {SCORED}, rows AS (SELECT * FROM scored), {_curve()}
        SELECT round({ROC}, 9) AS roc_auc FROM curve""",
    "pr_auc": f"""WITH {SCORED}, rows AS (SELECT * FROM scored), {_curve()}
        SELECT round({PR}, 9) AS pr_auc FROM curve""",
    "precision_recall_curve": f"""WITH {SCORED}, rows AS (SELECT * FROM scored), {_curve()}
        SELECT round(score, 9) AS score, CAST(tp AS BIGINT) AS true_positive, CAST(fp AS BIGINT) AS false_positive,
        round(CAST(tp AS DOUBLE) / (tp + fp), 9) AS precision, round(CAST(tp AS DOUBLE) / pos, 9) AS recall,
        round(CAST(p AS DOUBLE) / pos, 9) AS recall_delta FROM curve""",
    "mid_ranks": f"""WITH {SCORED}, ranked AS (SELECT score, rank() OVER (ORDER BY score) AS rk,
        count(*) OVER (PARTITION BY score) AS n FROM scored)
        SELECT round(score, 9) AS score, n, rk + (n - 1) / 2.0 AS mid_rank FROM ranked GROUP BY ALL""",
    "confusion_counts": f"""WITH {SCORED} SELECT count(*) FILTER (score >= 0.5 AND label = 1) AS true_positive,
        count(*) FILTER (score >= 0.5 AND label = 0) AS false_positive,
        count(*) FILTER (score < 0.5 AND label = 0) AS true_negative,
        count(*) FILTER (score < 0.5 AND label = 1) AS false_negative FROM scored""",
    "threshold_metrics": f"""WITH {SCORED}, {_report(threshold=0.5)}
        SELECT precision, recall, f1 FROM report""",
    "best_threshold": f"""WITH {SCORED}, {_report()}
        SELECT threshold, f1, precision, recall FROM report""",
    "brier": f"""WITH {SCORED} SELECT round(avg((score - label) * (score - label)), 9) AS brier_score
        FROM scored""",
    "classification_report": f"WITH {SCORED}, {_report()} SELECT * FROM report",
    "report_saturated_scores": f"""WITH {SCORED}, saturated AS (SELECT doc_id, label, source, lang,
        CASE WHEN doc_id % 10 = 0 THEN score ELSE 1.0 END AS score FROM scored),
        {_report(rows="SELECT * FROM saturated")} SELECT * FROM report""",
    "train_and_score": f"""WITH {LABELLED} SELECT doc_id, label, true AS is_probability,
        'char_ngram-v1' AS model_version FROM labelled""",
    "evaluate_model": f"""WITH {LABELLED}, uniq AS (SELECT DISTINCT text, label FROM labelled), {_three_way('uniq', 0.2)}
        SELECT 'char_ngram-v1' AS model_version, count(*) AS rows, count(*) FILTER (label = 1) AS positives,
        count(*) FILTER (label = 0) AS negatives, true AS metrics_in_range, 0 AS changed_by_saving
        FROM assigned WHERE split = 'test'""",
    "sweep": "SELECT * FROM (VALUES ('char_ngram', 6, 6), ('word_ngram', 6, 6)) AS t(family, metrics, in_range)",
    "stream_score_trained": """SELECT doc_id, true AS is_probability, 'char_ngram-v1' AS model_version,
        'valid' AS status FROM documents""",
    "csv_mixed_headers": f"WITH {CORPUS} SELECT doc_id, text, label, source FROM corpus",
    "parquet_mixed_schema": f"""WITH {CORPUS} SELECT doc_id, text, CASE WHEN label = 1 THEN source END AS source
        FROM corpus""",
    "mixed_format_folder": f"WITH {CORPUS} SELECT doc_id, text, label FROM corpus",
    "mixed_type_sources": f"""WITH {CORPUS}, said AS (SELECT doc_id, text, label, CASE WHEN doc_id % 3 = 1
            THEN CAST(doc_id % 50 AS VARCHAR) ELSE lpad(CAST(doc_id % 50 AS VARCHAR), 3, '0') END AS source FROM corpus)
        SELECT text, label, arg_min(source, doc_id) AS source FROM said GROUP BY text, label""",
    "published_exact_split": """SELECT DISTINCT text, CAST((doc_id // 10) % 2 AS INTEGER) AS label FROM documents
        WHERE doc_id % 10 < 8""",
    "license_numeric_source": """SELECT doc_id, CAST(doc_id % 20 AS VARCHAR) AS source_detail,
        'set' || doc_id % 20 AS source_dataset, 'mit' AS source_license FROM documents WHERE doc_id % 20 < 6""",
    "report_at_threshold": f"WITH {SCORED}, {_report(threshold=0.7)} SELECT * FROM report",
    "report_by_source": f"WITH {SCORED}, {_report(('source',))} SELECT * FROM report",
    "bce_loss": f"WITH {SCORED}, {LOGITS} SELECT round({LOSS}, 9) AS bce_loss FROM logits",
    "epoch_loss": f"WITH {SCORED}, {LOGITS}, {EPOCH_LOSS} SELECT epoch, loss FROM epoch_loss",
    "best_epoch": f"WITH {HISTORY} SELECT * FROM history ORDER BY roc_auc DESC NULLS LAST, epoch LIMIT 1",
    "best_epoch_by_loss": f"WITH {HISTORY} SELECT * FROM history ORDER BY val_loss, epoch LIMIT 1",
    "training_series": f"WITH {HISTORY} {SERIES}",
    "loggable_metrics": f"""WITH {SCORED}, {_report(('source',))}, logged AS
        ({_unpivot('report', 'source', LOGGED)}) SELECT source, 'val_' || metric AS metric, value FROM logged""",
    "leaderboard": f"""WITH {SCORED}, {_report(('lang', 'source'))}, board AS ({BOARD}),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang, metric ORDER BY
            CASE WHEN metric = 'brier_score' THEN value ELSE -value END, source) AS place FROM board)
        SELECT lang, metric, source, value FROM placed WHERE place = 1""",
    "latency_median": "SELECT round(median(value), 9) AS median FROM events",
    "latency_p95": f"""SELECT value AS p95 FROM (SELECT value, row_number() OVER (ORDER BY value) AS rk,
        count(*) OVER () AS n FROM events WHERE value IS NOT NULL) WHERE rk = {P95}""",
    "latency_p95_by_type": f"""SELECT event_type, value AS p95 FROM (SELECT event_type, value,
        row_number() OVER (PARTITION BY event_type ORDER BY value) AS rk,
        count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL) WHERE rk = {P95}""",
    "char_encode": f"""SELECT doc_id, array_to_string(list_transform(range(2048), lambda i:
        CASE WHEN i >= length(text) THEN 0 ELSE coalesce({CHAR_MAP}[unicode(substr(lower(text), i + 1, 1))], 1)
        END), ',') AS ids FROM documents""",
    "char_vocab_stats": f"""WITH chars AS (SELECT unnest(string_split(lower(text), '')) AS c FROM documents)
        SELECT coalesce({CHAR_MAP}[unicode(c)], 1) AS id, count(*) AS occurrences FROM chars
        WHERE c <> '' GROUP BY 1""",
    "csv_roundtrip": f"WITH {CORPUS} SELECT doc_id, text, label, source FROM corpus",
    "split_csv_roundtrip": f"""WITH {UNIQUE}, {_three_way('uniq')} SELECT text, label,
        '' AS source_dataset, '' AS source_detail, '' AS source_license, '' AS upstream_url, split FROM assigned""",
    "split_parquet_one": f"""WITH {UNIQUE}, {_three_way('uniq')}
        SELECT text, label FROM assigned WHERE split = 'test'""",
    "projected_scan": "SELECT text, source FROM documents",
    "training_scan": f"""WITH {DIRTY}, clean AS (SELECT trim(coalesce(essay, ''), {WS}) AS text,
        {_parse('spelled')} AS label FROM dirty) SELECT text, label FROM clean WHERE length(text) > 0""",
    "training_scan_limited": f"""WITH {DIRTY}, clean AS (SELECT trim(coalesce(essay, ''), {WS}) AS text,
        {_parse('spelled')} AS label FROM dirty), kept AS (SELECT text, label FROM clean WHERE length(text) > 0),
        {_balanced('kept', '(SELECT count(*) // 3 FROM documents)')} SELECT text, label FROM sampled""",
    "evaluation_scan": f"""WITH {DIRTY} SELECT coalesce(essay, '') AS text, {_parse('spelled')} AS label
        FROM dirty""",
    "ensured_table": f"WITH {CORPUS} SELECT label, count(*) AS rows FROM corpus GROUP BY label",
    "local_source": f"""WITH {CORPUS}, docs AS (SELECT text, label, arg_min(source, doc_id) AS source FROM corpus
        WHERE source IN ({PERMITTED}) GROUP BY text, label)
        SELECT text, label, source, dim.source_dataset, source AS source_detail, dim.source_license,
        dim.upstream_url, 'local' AS source_split FROM docs JOIN {DIMENSION} USING (source)""",
    "build_presplit": f"""WITH {PRESPLIT}, {ALLOCATION}, {PRESPLIT_SAMPLE} SELECT text, label,
        '' AS source_dataset, '' AS source_detail, '' AS source_license, '' AS upstream_url, split FROM sampled""",
    "build_local_presplit": f"""WITH {PRESPLIT} SELECT text, label, 'local' AS source_dataset,
        'local' AS source_detail, 'mit' AS source_license, '' AS upstream_url, split FROM presplit""",
    "build_multi_source": f"""WITH {MULTI} SELECT text, label, source_dataset, source_detail, source_license,
        upstream_url, split FROM assigned""",
    "prepare_two_way": f"""WITH {CORPUS}, docs AS (SELECT text, label, min(source) AS source FROM corpus
        WHERE source IN ({PERMITTED}) GROUP BY text, label), {_two_way('docs')}
        SELECT text, label, source, split FROM assigned""",
    "publish_build": f"""WITH {PUBLISH} SELECT text, label, source_dataset, source_detail,
        'mit' AS source_license, '' AS upstream_url, replace(split, 'val', 'validation') AS split FROM assigned""",
    "python_model_score": f"""SELECT doc_id, round({LENGTH_MODEL}, 9) AS prob_ai, 'length-v1' AS model_version
        FROM documents""",
    "python_model_report": f"""WITH {CORPUS}, scored AS (SELECT label, {LENGTH_MODEL} AS score FROM corpus),
        {_report(threshold=0.5)}
        SELECT *, 'length-v1' AS model_version, (SELECT count(*) FROM corpus) AS rows FROM report""",
    "stream_quota_batches": f"""WITH {CORPUS}, quota AS (SELECT count(*) * 3 // 5 AS m FROM corpus),
        ranked AS (SELECT text, label, row_number() OVER (PARTITION BY label
            ORDER BY (doc_id // 2) % 6, {_key('stream')}) AS rn FROM corpus)
        SELECT text, label, 'train' AS source_split FROM ranked, quota
        WHERE rn <= CASE WHEN label = 0 THEN m // 2 ELSE m - m // 2 END""",
    "stream_uncapped": f"WITH {CORPUS} SELECT DISTINCT text, label, 'train' AS source_split FROM corpus",
    "stream_quota_sample": f"""WITH {CORPUS}, quota AS (SELECT count(*) * 3 // 5 AS m FROM corpus),
        ranked AS (SELECT text, label, row_number() OVER (PARTITION BY label ORDER BY {_key('stream')}) AS rn
            FROM corpus)
        SELECT DISTINCT text, label, 'documents' AS source_dataset, 'train' AS source_split FROM ranked, quota
        WHERE rn <= CASE WHEN label = 0 THEN m // 2 ELSE m - m // 2 END""",
    "stream_dedup": f"WITH {CORPUS} SELECT DISTINCT text, label, 'train' AS source_split FROM corpus",
    "stream_score": f"""SELECT doc_id, CASE WHEN doc_id % 17 > 0 THEN round({LENGTH_MODEL}, 9) END AS prob_ai,
        CASE WHEN doc_id % 17 > 0 THEN 'length-v1' END AS model_version,
        CASE WHEN doc_id % 17 > 0 THEN 'valid' ELSE 'rejected' END AS status FROM documents""",
}
