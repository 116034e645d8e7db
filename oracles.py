"""The queries of ``feedback_loom.catalog`` in DuckDB SQL, over the same tables.

Common table expressions that several queries share are kept once in ``PARTS``;
``sql`` prefixes a query with those it names and the ones they need.
"""

from __future__ import annotations

import re
from pathlib import Path

STOP_WORDS = Path(__file__).resolve().parent / "feedback_loom" / "sources" / "stop_words"
LANGUAGES = ("english", "french", "german", "spanish")
ISSUES, REASONS, COLON, FALLBACK = "体验问题", "推理原因", "：", "其他问题"


def stop_words() -> list[str]:
    """The public stop word lists kept beside the library, as ``default_stop_words`` gives them."""
    found: set[str] = set()
    for language in LANGUAGES:
        lines = (STOP_WORDS / f"{language}.txt").read_text(encoding="utf-8").splitlines()
        found.update(line.strip().lower() for line in lines if line.strip() and not line.startswith("#"))
    return sorted(found)


def _quoted(words: list[str]) -> str:
    return ", ".join("('" + w.replace("'", "''") + "')" for w in words)


PARTS = {
    "stop": lambda: f"stop(term) AS (VALUES {_quoted(stop_words())})",
    "raw_words": """raw_words AS (
        SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term
        FROM documents)""",
    "words": "words AS (SELECT * FROM raw_words WHERE NOT regexp_full_match(term, '[0-9]+'))",
    "clean": "clean AS (SELECT * FROM words WHERE term NOT IN (SELECT term FROM stop))",
    "tf": "tf AS (SELECT doc_id, term, count(*) AS tf FROM clean GROUP BY doc_id, term)",
    "counts": "counts AS (SELECT term, sum(tf)::BIGINT AS cf, count(*) AS df FROM tf GROUP BY term)",
    "voc": "voc AS (SELECT * FROM counts ORDER BY cf DESC, term LIMIT 1000)",
    "total": "total AS (SELECT count(*) AS n FROM documents)",
    "raw_weights": """raw_weights AS (
        SELECT doc_id, term, tf * (ln((1 + n) / (1.0::DOUBLE + df)) + 1) AS w FROM tf JOIN voc USING (term), total)""",
    "weights": "weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw_weights)",
    "by_source": """by_source AS (
        SELECT source, term, sum(weight) / max(size) AS weight FROM weights JOIN documents USING (doc_id)
        JOIN (SELECT source, count(*) AS size FROM documents GROUP BY source) USING (source) GROUP BY source, term)""",
    "by_lang": """by_lang AS (
        SELECT lang, term, sum(weight) / max(size) AS weight FROM weights JOIN documents USING (doc_id)
        JOIN (SELECT lang, count(*) AS size FROM documents GROUP BY lang) USING (lang) GROUP BY lang, term)""",
    "top_by_source": """top_by_source AS (
        SELECT * FROM (SELECT source, term, weight,
            row_number() OVER (PARTITION BY source ORDER BY round(weight, 6) DESC, term) AS rn
        FROM by_source WHERE round(weight, 6) > 0) WHERE rn <= 10)""",
    "polarity": "polarity AS (SELECT doc_id, quality = 1 AND toxic = 0 AS positive FROM labels)",
    "lexicon": """lexicon AS (
        SELECT term, sign(log_odds) AS polarity FROM (
            SELECT term, ln((pos + 1.0) / (P + 2.0)) - ln((neg + 1.0) / (N + 2.0)) AS log_odds, pos + neg AS hits FROM (
                SELECT term, count(*) FILTER (positive) AS pos, count(*) FILTER (NOT positive) AS neg
                FROM (SELECT DISTINCT doc_id, term FROM words) JOIN polarity USING (doc_id) GROUP BY term),
            (SELECT count(*) FILTER (positive) AS P, count(*) FILTER (NOT positive) AS N
             FROM polarity JOIN documents USING (doc_id)))
        WHERE hits >= 5 AND abs(log_odds) >= 0.5)""",
    "scored": """scored AS (
        SELECT doc_id, CASE WHEN w > 0 THEN least(10, greatest(0, floor(5.5 + 5.0 * p / w))) ELSE 5 END::INTEGER AS score
        FROM documents LEFT JOIN (
            SELECT doc_id, sum(polarity)::DOUBLE AS p, sum(abs(polarity))::DOUBLE AS w
            FROM (SELECT DISTINCT doc_id, term FROM words) JOIN lexicon USING (term) GROUP BY doc_id) USING (doc_id))""",
    "partly": """partly AS (
        SELECT d.*, CASE WHEN p.positive THEN 8 WHEN NOT p.positive THEN 2 END AS score,
            CASE WHEN p.positive IS NOT NULL THEN d.source END AS class
        FROM documents d LEFT JOIN polarity p USING (doc_id))""",
    "batched": """batched AS (
        SELECT *, ((place - 1) // 30)::BIGINT AS batch_no, ((place - 1) % 30)::INTEGER AS pos FROM (
            SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id) AS place FROM (
                SELECT d.*, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT)
                    % (SELECT greatest(1, ceil(count(*) / 3000.0))::BIGINT FROM documents) AS bucket
                FROM documents d)))""",
    "score_answers": """score_answers AS (
        SELECT bucket, batch_no, n, CASE WHEN batch_no % 11 = 10 THEN ''
            WHEN batch_no % 5 = 0 THEN ' <sep>' || list || '<sep>' || chr(10) ELSE list END AS response
        FROM (SELECT bucket, batch_no, count(*)::INTEGER AS n, string_agg(
            CASE WHEN doc_id % 97 = 0 THEN '11' WHEN doc_id % 89 = 0 THEN '7.5' WHEN doc_id % 83 = 0 THEN '3<sep>4'
                ELSE (n_chars % 11)::VARCHAR END, '<sep>' ORDER BY doc_id) AS list FROM batched GROUP BY bucket, batch_no))""",
    "label_answers": """label_answers AS (
        SELECT bucket, batch_no, n, CASE WHEN batch_no % 11 = 10 THEN ''
            WHEN batch_no % 5 = 0 THEN ' <sep>' || list || '<sep>' || chr(10) ELSE list END AS response
        FROM (SELECT bucket, batch_no, count(*)::INTEGER AS n, string_agg(
            CASE WHEN doc_id % 97 = 0 THEN 'elsewhere' WHEN doc_id % 83 = 0 THEN 'src1<sep>src2' ELSE source END,
            '<sep>' ORDER BY doc_id) AS list FROM batched GROUP BY bucket, batch_no))""",
    "bare_scores": """bare_scores AS (
        SELECT *, regexp_replace(regexp_replace(response, '^\\s+|\\s+$', '', 'g'), '^(<sep>)+|(<sep>)+$', '', 'g') AS bare
        FROM score_answers)""",
    "bare_labels": """bare_labels AS (
        SELECT *, regexp_replace(regexp_replace(response, '^\\s+|\\s+$', '', 'g'), '^(<sep>)+|(<sep>)+$', '', 'g') AS bare
        FROM label_answers)""",
    "score_status": """score_status AS (
        SELECT *, CASE WHEN len(string_split(bare, '<sep>')) <> n THEN 'count'
            WHEN NOT regexp_full_match(bare, '(([0-9]|10)<sep>)*([0-9]|10)') THEN 'format' ELSE 'ok' END AS status
        FROM bare_scores)""",
    "group_answers": f"""group_answers AS (
        SELECT source, CASE k WHEN 3 THEN i WHEN 4 THEN i || '<sep0>' || r WHEN 5 THEN i || '<sep0>3.x<sep1>' || r
            WHEN 6 THEN i || '<sep1>' || r || '<sep1>' || chr(10) ELSE i || '<sep1>' || chr(10) || r END AS response
        FROM (SELECT source, regexp_extract(source, '[0-9]+')::INTEGER % 7 AS k,
            '{ISSUES}{COLON}1.' || min(lang) || '<sep0>2.' || max(lang) AS i,
            '{REASONS}{COLON}1.' || count(*) || '<sep0>2.' || max(n_chars) AS r FROM documents GROUP BY source))""",
    "group_lists": f"""group_lists AS (
        SELECT *, string_split(bare, '<sep1>') AS lists FROM (
            SELECT *, regexp_replace(regexp_replace(response, '^\\s+|\\s+$', '', 'g'), '^(<sep1>)+|(<sep1>)+$', '', 'g') AS bare
            FROM group_answers))""",
    "group_status": f"""group_status AS (
        SELECT *, CASE WHEN NOT (contains(response, '{ISSUES}') AND contains(response, '{REASONS}')) THEN 'omitted'
            WHEN len(lists) <> 2 THEN 'separator'
            WHEN len(string_split(lists[1], '<sep0>')) <> len(string_split(lists[2], '<sep0>')) THEN 'pair_count'
            ELSE 'ok' END AS status FROM group_lists)""",
    "sections": f"""sections AS (
        SELECT source,
            replace(regexp_extract(response, '(?s){ISSUES}{COLON}(.*)<sep1>.*{REASONS}{COLON}', 1), '<sep0>', ',') AS issues,
            replace(regexp_extract(bare, '(?s){ISSUES}{COLON}.*<sep1>.*{REASONS}{COLON}(.*)', 1), '<sep0>', ',') AS reasons,
            replace(regexp_replace(regexp_extract(response, '(?s){REASONS}{COLON}(.*)', 1), '^\\s+|\\s+$', '', 'g'), '<sep>', ',') AS tail
        FROM group_status WHERE status = 'ok')""",
    "label_lists": """label_lists AS (
        SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Labels：1.' || source || '<sep>2.' || lang || 'é<sep>'
            WHEN 1 THEN '1.' || lang || '<sep>2.价格 x<sep>10.' || source
            WHEN 2 THEN '1.' || lang || '问题<sep>2.' || source WHEN 3 THEN 'none for ' || lang
            ELSE '<sep>7、' || lang || '_x' END AS answer FROM documents)""",
    "listed": """listed AS (
        SELECT doc_id, replace(regexp_replace(answer, '^(<sep>)+|(<sep>)+$', '', 'g'), '<sep>', ',') AS listed FROM label_lists)""",
    "reviews": """reviews AS (
        SELECT doc_id AS review_id, CASE doc_id % 7 WHEN 0 THEN 'y' WHEN 1 THEN 'n<sep>merge ' || lang WHEN 2 THEN 'n'
            WHEN 3 THEN '1.' || source || '<sep>2.' || lang WHEN 4 THEN 'no idea' WHEN 5 THEN '1.' || lang || '<sep>two'
            ELSE 'yes ' || source END AS answer FROM documents)""",
    "routed": """routed AS (
        SELECT *, CASE WHEN answer = 'y' THEN 'accept' WHEN answer = 'n' OR starts_with(answer, 'n<sep>') THEN 'redo'
            WHEN regexp_full_match(replace(answer, '<sep>', ','), '([0-9]+.[\\p{L}\\p{N}_]+,)*[0-9]+.[\\p{L}\\p{N}_]+') THEN 'replace'
            ELSE 'invalid' END AS decision FROM reviews)""",
    "cells": """cells AS (
        SELECT k, floor(x * k / (longest + 1.0::DOUBLE)) AS cell, count(*) AS n, sum(x)::BIGINT AS s, sum(x * x)::BIGINT AS q
        FROM (SELECT length(text)::BIGINT AS x FROM documents), (SELECT unnest(range(1, 21))::INTEGER AS k),
            (SELECT max(length(text)) AS longest FROM documents) GROUP BY ALL)""",
    "curve": """curve AS (
        SELECT k, round(sum(q - s::DOUBLE * s::DOUBLE / n) / 1e6, 4) AS sse FROM cells GROUP BY k)""",
    "fitted": """fitted AS (
        SELECT k, sse, y1 + (y2 - y1) / (k2 - k1) * (k - k1) AS fitted
        FROM curve, (SELECT min(k) AS k1, max(k) AS k2, arg_min(sse, k) AS y1, arg_max(sse, k) AS y2 FROM curve))""",
    "elbow": """elbow AS (
        SELECT *, abs(sse - fitted) AS residual, row_number() OVER (ORDER BY abs(sse - fitted) DESC, k) = 1 AS is_elbow
        FROM fitted)""",
    "class_shares": """class_shares AS (
        SELECT class, count(*) AS count, count(*) / (SELECT count(*) FROM documents) AS percentage,
            avg(score::DOUBLE) AS score FROM partly WHERE class IS NOT NULL GROUP BY class)""",
    "unit_source": "unit_source AS (SELECT source, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY source)) AS c FROM by_source)",
    "unit_lang": "unit_lang AS (SELECT lang, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY lang)) AS c FROM by_lang)",
    "sampled": """sampled AS (
        SELECT * FROM (SELECT lang, doc_id, text, row_number() OVER (
            PARTITION BY lang ORDER BY md5('1:' || doc_id), doc_id) AS rn FROM documents) WHERE rn <= 100)""",
    "bodies": "bodies AS (SELECT lang, string_agg(text, chr(10) ORDER BY doc_id) AS body FROM sampled GROUP BY lang)",
    "lang_500": """lang_500 AS (
        SELECT lang, string_agg(text, chr(10) ORDER BY doc_id) AS body FROM (SELECT lang, doc_id, text, row_number() OVER (
            PARTITION BY lang ORDER BY md5('1:' || doc_id), doc_id) AS rn FROM documents) WHERE rn <= 500 GROUP BY lang)""",
    "typical": """typical AS (
        SELECT source, sentence, coalesce(rn_cap, 500) AS rn_cap,
            round(sum(coalesce(weight, 0)) / count(*), 6) AS typicality
        FROM (SELECT DISTINCT source, sentence, rn_cap, term FROM (
            SELECT source, sentence, rn_cap, unnest(regexp_extract_all(lower(sentence), '[\\p{L}\\p{N}_]{2,}')) AS term
            FROM (SELECT DISTINCT source, rn_cap, trim(unnest(regexp_split_to_array(text, '[.!?。！？\\n]+'))) AS sentence
                FROM (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY md5('1:' || doc_id), doc_id) AS rn
                    FROM documents), (VALUES (100), (500)) caps(rn_cap) WHERE rn <= rn_cap)
            WHERE length(sentence) >= 20) WHERE NOT regexp_full_match(term, '[0-9]+'))
        LEFT JOIN by_source USING (source, term) GROUP BY source, sentence, rn_cap)""",
    "causes": """causes AS (
        SELECT source, rn_cap, sentence, rn FROM (SELECT *, row_number() OVER (
            PARTITION BY source, rn_cap ORDER BY typicality DESC, sentence) AS rn FROM typical) WHERE rn <= 10)""",
    "overlap": """overlap AS (
        SELECT left_group, right_group, shared, shared / (ls + rs - shared) AS jaccard FROM (
            SELECT a.source AS left_group, b.source AS right_group, a.size AS ls, b.size AS rs, count(*) AS shared
            FROM (SELECT *, count(*) OVER (PARTITION BY source) AS size FROM top_by_source) a
            JOIN (SELECT *, count(*) OVER (PARTITION BY source) AS size FROM top_by_source) b
                ON a.term = b.term AND a.source < b.source GROUP BY ALL))""",
    "concluded": """concluded AS (
        SELECT row_number() OVER (ORDER BY percentage DESC, class)::INTEGER AS rank, class,
            round_even(percentage * 100, 2) AS pct, reasons
        FROM class_shares JOIN (SELECT source AS class, min(lang) || ',' || max(n_chars) AS reasons
            FROM documents GROUP BY source) USING (class))""",
    "concl_lines": """concl_lines AS (
        SELECT rank, class, pct, rank || '. ' || class || ', share of texts ' || pct || '%, causes: ' || reasons AS line
        FROM concluded)""",
}

QUERIES = {
    "read_texts_csv": "SELECT doc_id AS row_id, text AS content FROM documents",
    "read_stop_words": "SELECT term FROM (SELECT term, count(DISTINCT doc_id) AS df FROM words GROUP BY term) "
                       "WHERE df * 5 >= (SELECT n FROM total)",
    "preview_texts": "SELECT doc_id AS row_id, text AS content FROM documents ORDER BY doc_id LIMIT 5",
    "preview_conclusion": "SELECT * FROM concl_lines WHERE rank <= 3",
    "pending_column": "SELECT doc_id AS row_id, NULL::INTEGER AS score, NULL::VARCHAR AS class FROM documents",
    "score_as_double": """SELECT bucket, batch_no, (pos - 1)::INTEGER AS pos, item, try_cast(item AS DOUBLE) AS score FROM (
        SELECT bucket, batch_no, unnest(items) AS item, generate_subscripts(items, 1) AS pos
        FROM (SELECT bucket, batch_no, string_split(bare, '<sep>') AS items FROM bare_scores))""",
    "sentiment_bands": """SELECT doc_id AS row_id, score,
        CASE WHEN score <= 3 THEN 'negative' WHEN score <= 6 THEN 'neutral' ELSE 'positive' END AS band FROM scored""",
    "negative_texts": "SELECT doc_id AS row_id, text AS content, score FROM scored JOIN documents USING (doc_id) WHERE score <= 3",
    "pending_rows": "SELECT doc_id AS row_id, lang, source FROM partly WHERE score IS NULL",
    "negative_positions": "SELECT doc_id AS row_id, n_chars, score FROM partly WHERE score <= 3",
    "annotated_columns": "SELECT text AS content, score, class FROM partly",
    "percent_display": """SELECT lang, round_even(share * 100, 2) AS pct, round_even(share * 100, 2) || '%' AS shown
        FROM (SELECT lang, count(*) / (SELECT n FROM total) AS share FROM documents GROUP BY lang)""",
    "write_back_items": """SELECT doc_id AS row_id, string_split(bare, '<sep>')[pos + 1]::INTEGER AS score
        FROM batched JOIN score_status USING (bucket, batch_no) WHERE status = 'ok'""",
    "write_back_groups": """SELECT source, count(*) AS n, any_value(issues) AS issues, any_value(reasons) AS reasons
        FROM documents LEFT JOIN sections USING (source) GROUP BY source""",
    "count_with_mean": "SELECT source, count(*) AS n, round(avg(score::DOUBLE), 6) AS mean_score FROM partly GROUP BY source",
    "all_clusters": """SELECT cluster, count(source) AS comment_cnt, round(count(source) / (SELECT n FROM total), 6) AS comment_pct
        FROM (SELECT unnest(range(0, (SELECT max(regexp_extract(source, '[0-9]+')::INTEGER) FROM documents) + 6))::INTEGER AS cluster)
        LEFT JOIN documents ON cluster = regexp_extract(source, '[0-9]+')::INTEGER GROUP BY cluster""",
    "stop_word_exclusion": "SELECT term, cf FROM counts",
    "label_membership": """SELECT bucket, batch_no, count(*) FILTER (item NOT IN (SELECT source FROM documents)) AS misses
        FROM (SELECT bucket, batch_no, unnest(string_split(bare, '<sep>')) AS item FROM bare_labels) GROUP BY bucket, batch_no""",
    "texts_per_group": "SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars, min(doc_id) AS first_id FROM documents GROUP BY source",
    "class_counts": "SELECT class, count FROM class_shares",
    "class_shares": "SELECT class, round(percentage, 6) AS percentage FROM class_shares",
    "class_mean_score": "SELECT class, round(score, 6) AS score FROM class_shares",
    "cluster_shares": """SELECT regexp_extract(source, '[0-9]+')::INTEGER AS cluster, count(*) AS comment_cnt,
        round(count(*) / (SELECT n FROM total), 6) AS comment_pct, round(avg(score::DOUBLE), 6) AS score FROM partly GROUP BY 1""",
    "joined_batch_texts": """SELECT bucket, batch_no, count(*) AS n,
        string_agg(regexp_replace(text, '<sep[01]?>', ' ', 'g'), '<sep>' ORDER BY doc_id) AS body FROM batched GROUP BY bucket, batch_no""",
    "pending_counts": """SELECT count(*) AS total, count(*) FILTER (score IS NULL) AS pending,
        count(*) FILTER (score IS NOT NULL) AS done FROM partly""",
    "term_counts": "SELECT * FROM counts",
    "kept_class_summary": """SELECT class, count, round(percentage, 6) AS percentage, round(score, 6) AS score FROM class_shares""",
    "kept_term_counts": "SELECT * FROM counts",
    "single_cluster_error": """SELECT n, round((SELECT sum(weight * weight) FROM weights)
        - (SELECT sum(s * s) FROM (SELECT sum(weight) AS s FROM weights GROUP BY term)) / n, 4) AS sse FROM total""",
    "cluster_sweep_facts": """SELECT 20::BIGINT AS n, 1 AS first_k, 20 AS last_k, round((SELECT sum(weight * weight) FROM weights)
        - (SELECT sum(s * s) FROM (SELECT sum(weight) AS s FROM weights GROUP BY term)) / n, 4) AS single_sse,
        1::BIGINT AS elbows FROM total""",
    "clustered_text_facts": "SELECT 0 AS first, true AS dense, n AS texts, 1.0::DOUBLE AS share FROM total",
    "analysis_facts": """SELECT count(*) AS texts, 1.0::DOUBLE AS share, 1 AS first, true AS dense FROM scored WHERE score <= 3""",
    "stored_outputs": "SELECT 'classified' AS output, count(*) AS n_rows FROM scored WHERE score <= 3",
    "distinct_labels": "SELECT DISTINCT lang || '_' || source AS label FROM documents",
    "first_texts_per_group": """SELECT source, string_agg(text, chr(10) ORDER BY doc_id) AS sample_cases FROM (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 5 GROUP BY source""",
    "sampled_texts_per_group": "SELECT lang, rn::INTEGER AS rn, doc_id AS row_id, text AS content FROM sampled",
    "top_terms_per_group": """SELECT lang, rn::INTEGER AS rn, term, round(weight, 6) AS weight FROM (SELECT *, row_number() OVER (
        PARTITION BY lang ORDER BY round(weight, 6) DESC, term) AS rn FROM by_lang) WHERE rn <= 10""",
    "batch_numbers": "SELECT doc_id AS row_id, bucket, batch_no, pos FROM batched",
    "vocabulary_cap": "SELECT * FROM voc",
    "elbow_pick": "SELECT k, sse FROM elbow WHERE is_elbow",
    "class_order": "SELECT class, count, row_number() OVER (ORDER BY class)::INTEGER AS place FROM class_shares",
    "conclusion_rank": "SELECT row_number() OVER (ORDER BY percentage DESC, class)::INTEGER AS rank, class, count FROM class_shares",
    "labels_with_fallback": f"""WITH found AS (SELECT DISTINCT unnest(regexp_extract_all(listed, '(?s)[0-9]+.([\\p{{L}}\\p{{N}}_]+)', 1)) AS label FROM listed),
        numbered AS (SELECT row_number() OVER (ORDER BY label)::INTEGER AS label_id, label FROM found)
        SELECT * FROM numbered UNION ALL SELECT (max(label_id) + 1)::INTEGER, '{FALLBACK}' FROM numbered""",
    "merged_results": "SELECT doc_id AS row_id, coalesce(p.score, s.score) AS score FROM partly p JOIN scored s USING (doc_id)",
    "stripped_answers": "SELECT bucket, batch_no, bare FROM bare_scores",
    "split_answers": """SELECT bucket, batch_no, (generate_subscripts(items, 1) - 1)::INTEGER AS pos, unnest(items) AS item
        FROM (SELECT bucket, batch_no, string_split(bare, '<sep>') AS items FROM bare_scores)""",
    "answer_counts": """SELECT bucket, batch_no, n, len(string_split(bare, '<sep>'))::INTEGER AS items,
        len(string_split(bare, '<sep>')) = n AS complete FROM bare_scores""",
    "score_format": """SELECT bucket, batch_no, regexp_full_match(bare, '(([0-9]|10)<sep>)*([0-9]|10)') AS well_formed FROM bare_scores""",
    "required_headings": f"""SELECT source, contains(response, '{ISSUES}') AS has_issues,
        contains(response, '{REASONS}') AS has_reasons FROM group_answers""",
    "section_counts": """SELECT source, len(lists)::INTEGER AS lists, len(string_split(lists[1], '<sep0>'))::INTEGER AS first_items,
        coalesce(len(string_split(lists[2], '<sep0>')), -1)::INTEGER AS second_items FROM group_lists""",
    "extracted_sections": "SELECT * FROM sections",
    "numbered_labels": """SELECT doc_id AS row_id, array_to_string(regexp_extract_all(listed, '(?s)[0-9]+.([\\p{L}\\p{N}_]+)', 1), '|') AS labels
        FROM listed""",
    "numbered_list_check": """SELECT doc_id AS row_id, regexp_full_match(listed, '(?s)([0-9]+.[\\p{L}\\p{N}_]+,)*[0-9]+.[\\p{L}\\p{N}_]+') AS is_list
        FROM listed""",
    "answer_routing": "SELECT review_id, decision FROM routed",
    "templated_lines": """SELECT source, 'Source ' || source || ' holds ' || count(*) || ' texts, last language ' || max(lang) || '.' AS line
        FROM documents GROUP BY source""",
    "long_words": """SELECT term, count(*) AS n FROM (
        SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS term FROM documents)
        WHERE length(term) > 1 GROUP BY term""",
    "words_per_text": "SELECT doc_id AS row_id, term, count(*) AS n FROM words GROUP BY doc_id, term",
    "chord_distance": "SELECT k, round(fitted, 4) AS fitted, round(residual, 4) AS residual FROM elbow",
    "clean_tokens": "SELECT doc_id AS row_id, term, tf AS n FROM tf",
    "tfidf_weights": "SELECT doc_id AS row_id, term, round(weight, 6) AS weight FROM weights",
    "elbow_curve": "SELECT k, sse, round(fitted, 4) AS fitted, round(residual, 4) AS residual, is_elbow FROM elbow",
    "nearest_centroid": """SELECT doc_id AS row_id, source, similarity FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, source) AS rn FROM (
            SELECT doc_id, source, round(sum(weight * c), 6) AS similarity FROM weights JOIN unit_source USING (term)
            GROUP BY doc_id, source)) WHERE rn = 1""",
    "group_keywords": "SELECT source, string_agg(term, ', ' ORDER BY rn) AS keywords FROM top_by_source GROUP BY source",
    "group_summary": """WITH cases AS (SELECT source, string_agg(text, chr(10) ORDER BY doc_id) AS sample_cases FROM (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 5 GROUP BY source),
        shares AS (SELECT source, count(*) AS cnt, avg(score::DOUBLE) AS score FROM partly GROUP BY source),
        keywords AS (SELECT source, string_agg(term, ', ' ORDER BY rn) AS keywords FROM top_by_source GROUP BY source)
        SELECT cluster, coalesce(keywords, '') AS keywords, coalesce(sample_cases, '') AS sample_cases,
            coalesce(cnt, 0) AS comment_cnt, round(coalesce(cnt, 0) / (SELECT n FROM total), 6) AS comment_pct,
            round(score, 6) AS score
        FROM (SELECT unnest(range(0, (SELECT max(regexp_extract(source, '[0-9]+')::INTEGER) FROM documents) + 6))::INTEGER AS cluster)
        LEFT JOIN shares s ON s.source = 'src' || cluster LEFT JOIN cases c ON c.source = s.source
        LEFT JOIN keywords w ON w.source = s.source""",
    "class_summary": """SELECT class, count, round(percentage, 6) AS percentage, round(score, 6) AS score, NULL::VARCHAR AS reasons
        FROM class_shares""",
    "induced_lexicon": "SELECT term, polarity::INTEGER AS polarity FROM lexicon",
    "score_texts": "SELECT doc_id AS row_id, score FROM scored",
    "negative_shares": """WITH neg AS (SELECT source, score FROM scored JOIN documents USING (doc_id) WHERE score <= 3)
        SELECT source, count(*) AS count, round(count(*) / (SELECT count(*) FROM neg), 6) AS percentage,
            round(avg(score::DOUBLE), 6) AS score FROM neg GROUP BY source""",
    "scored_by_function": """SELECT doc_id AS row_id,
        CASE WHEN length(text) % 13 <> 0 THEN (length(text) % 11)::INTEGER END AS score FROM documents""",
    "quarantined_rows": "SELECT doc_id AS row_id, 'format' AS status, 'n/a' AS response FROM documents WHERE length(text) % 13 = 0",
    "resumed_run": """SELECT doc_id AS row_id, CASE WHEN length(text) % 13 <> 0 THEN (length(text) % 11)::INTEGER END AS score,
        0::BIGINT AS asked_again FROM documents""",
    "run_rounds": """WITH texts AS (SELECT min(doc_id) AS id FROM documents WHERE regexp_matches(text, '\\S') GROUP BY text),
        buckets AS (SELECT ('0x' || substr(md5(id::VARCHAR), 1, 8))::BIGINT
            % (SELECT greatest(1, (count(*) + 2999) // 3000) FROM texts) AS bucket FROM texts)
        SELECT 'score' AS step, 0 AS round, sum((n + 29) // 30)::BIGINT AS prompts, 1 AS passes
        FROM (SELECT count(*) AS n FROM buckets GROUP BY bucket)""",
    "equal_texts": """SELECT doc_id AS row_id, min(doc_id) OVER copies AS asked_row, count(*) OVER copies AS copies
        FROM documents WHERE regexp_matches(text, '\\S') WINDOW copies AS (PARTITION BY text)""",
    "described_by_function": """SELECT lang, '1.chars ' || length(body) || ',2.lines' AS issues,
        '1.length,2.' || (length(body) - length(replace(body, chr(10), '')) + 1) AS reasons FROM bodies""",
    "group_prompts": "SELECT * FROM bodies",
    "group_issues": """SELECT regexp_extract(source, '[0-9]+')::INTEGER AS cluster, issues, reasons FROM
        (SELECT source, string_agg(rn || '.' || term, ',' ORDER BY rn) AS issues FROM top_by_source WHERE rn <= 5 GROUP BY source)
        JOIN (SELECT source, string_agg(rn || '.' || sentence, ',' ORDER BY rn) AS reasons FROM causes
            WHERE rn_cap = 100 AND rn <= 5 GROUP BY source) USING (source)""",
    "label_proposals": f"""SELECT doc_id AS row_id, (generate_subscripts(found, 1) - 1)::INTEGER AS pos, unnest(found) AS label
        FROM (SELECT doc_id, regexp_extract_all(listed, '(?s)[0-9]+.([\\p{{L}}\\p{{N}}_]+)', 1) AS found FROM listed)
        UNION ALL SELECT doc_id, -1, '{FALLBACK}' FROM documents""",
    "term_overlap": "SELECT left_group, right_group, shared, round(jaccard, 6) AS jaccard FROM overlap",
    "merged_groups": """WITH RECURSIVE links AS (
            SELECT left_group AS a, right_group AS b FROM overlap WHERE jaccard >= 0.5
            UNION SELECT right_group, left_group FROM overlap WHERE jaccard >= 0.5),
        reach(source, other) AS (SELECT DISTINCT source, source FROM top_by_source
            UNION SELECT source, b FROM reach JOIN links ON other = a),
        merged AS (SELECT source, min(other) AS merged FROM reach GROUP BY source),
        named AS (SELECT source AS merged, string_agg(term, '_' ORDER BY rn) AS label FROM top_by_source WHERE rn <= 2 GROUP BY source),
        numbered AS (SELECT label, row_number() OVER (ORDER BY min(merged))::INTEGER AS label_id
            FROM named WHERE merged IN (SELECT merged FROM merged) GROUP BY label)
        SELECT source, label_id, label FROM merged JOIN named USING (merged) JOIN numbered USING (label)""",
    "label_reviews": """SELECT review_id, decision, CASE WHEN starts_with(answer, 'n<sep>') THEN string_split(answer, '<sep>')[-1] END AS hint,
        CASE WHEN decision = 'replace' THEN array_to_string(regexp_extract_all(
            replace(answer, '<sep>', ','), '(?s)[0-9]+.([\\p{L}\\p{N}_]+)', 1), '|') END AS labels FROM routed""",
    "hint_wishes": """WITH hinted AS (
            SELECT doc_id AS review_id, lower(CASE doc_id % 4 WHEN 0 THEN 'please Merge ' || source || ' and ' || lang
                WHEN 1 THEN 'split ' || lang || ' from ' || source || '; merge x_1 with ' || source WHEN 2 THEN 'merge ' || lang
                ELSE 'submerge ' || lang || ' and ' || source END) AS hint,
                '(?:^|[^\\p{L}\\p{N}_])(merge|split)\\s+([\\p{L}\\p{N}_]+)\\s+(?:and|with|from)\\s+([\\p{L}\\p{N}_]+)' AS wish
            FROM documents),
        found AS (SELECT review_id, regexp_extract_all(hint, wish, 1) AS kinds, regexp_extract_all(hint, wish, 2) AS lefts,
            regexp_extract_all(hint, wish, 3) AS rights FROM hinted)
        SELECT review_id, (generate_subscripts(kinds, 1) - 1)::INTEGER AS no, unnest(kinds) AS kind, unnest(lefts) AS left_name,
            unnest(rights) AS right_name FROM found""",
    "wished_groups": """WITH RECURSIVE firsts AS (SELECT term FROM top_by_source WHERE rn = 1 ORDER BY source LIMIT 2),
        wished AS (SELECT DISTINCT source FROM top_by_source WHERE term IN (SELECT lower(term) FROM firsts)),
        links AS (SELECT left_group AS a, right_group AS b FROM overlap WHERE jaccard >= 0.5
            UNION SELECT right_group, left_group FROM overlap WHERE jaccard >= 0.5
            UNION SELECT source, (SELECT min(source) FROM wished) FROM wished
            UNION SELECT (SELECT min(source) FROM wished), source FROM wished),
        reach(source, other) AS (SELECT DISTINCT source, source FROM top_by_source
            UNION SELECT source, b FROM reach JOIN links ON other = a)
        SELECT source, min(other) AS merged FROM reach GROUP BY source""",
    "classified_by_cosine": f"""WITH best AS (SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, lang) AS rn FROM (
                SELECT doc_id, lang, round(sum(weight * c), 6) AS similarity FROM weights JOIN unit_lang USING (term)
                GROUP BY doc_id, lang)) WHERE rn = 1 AND similarity >= 0.3)
        SELECT d.doc_id AS row_id, coalesce(best.lang, '{FALLBACK}') AS class FROM documents d LEFT JOIN best USING (doc_id)""",
    "classified_by_function": """SELECT doc_id AS row_id, CASE WHEN length(text) % 17 <> 0 THEN
        (SELECT list(source ORDER BY source) FROM (SELECT DISTINCT source FROM documents))
            [length(text) % (SELECT count(DISTINCT source) FROM documents) + 1] END AS class FROM documents""",
    "typical_causes": """SELECT source, string_agg(rn || '.' || sentence, ',' ORDER BY rn) AS reasons FROM causes
        WHERE rn_cap = 500 GROUP BY source""",
    "explained_by_function": """SELECT lang AS class, count(*) AS count, round(count(*) / (SELECT n FROM total), 6) AS percentage,
        '1.' || (length('Problem: ' || lang || chr(10) || 'Texts:' || chr(10)) + any_value(length(body))) || ' characters,2.of text' AS reasons
        FROM documents JOIN lang_500 USING (lang) GROUP BY lang""",
    "conclusion_lines": "SELECT * FROM concl_lines",
    "conclusion_text": "SELECT string_agg(line, chr(10) ORDER BY rank) AS conclusion FROM concl_lines",
    "answer_status": f"""SELECT 'score' AS kind, bucket || '/' || batch_no AS key, status FROM score_status
        UNION ALL SELECT 'label', bucket || '/' || batch_no, CASE WHEN len(string_split(bare, '<sep>')) <> n THEN 'count'
            WHEN NOT list_has_all((SELECT list(DISTINCT source) FROM documents), string_split(bare, '<sep>')) THEN 'label'
            ELSE 'ok' END FROM bare_labels
        UNION ALL SELECT 'issue', source, status FROM group_status
        UNION ALL SELECT 'reason', source, CASE WHEN contains(response, '{REASONS}{COLON}') THEN 'ok' ELSE 'omitted' END FROM group_answers""",
    "resumed_scores": """SELECT doc_id AS row_id, coalesce(p.score, s.score) AS score, p.score IS NOT NULL AS resumed
        FROM partly p JOIN scored s USING (doc_id)""",
}


def sql(name: str) -> str:
    """A query with the shared expressions it uses, each once and in order."""
    body = QUERIES[name]
    texts: dict[str, str] = {}
    needed: set[str] = set()

    def collect(text: str) -> None:
        for part in PARTS:
            if part not in needed and re.search(rf"\b{part}\b", text):
                needed.add(part)
                texts[part] = PARTS[part]() if callable(PARTS[part]) else PARTS[part]
                collect(texts[part].split(" AS ", 1)[1])

    collect(body)
    shared = []

    def place(part: str) -> None:
        if part in shared:
            return
        definition = texts[part].split(" AS ", 1)[1]
        for other in PARTS:
            if other != part and other in needed and re.search(rf"\b{other}\b", definition):
                place(other)
        shared.append(part)

    for part in PARTS:
        if part in needed:
            place(part)
    if not shared:
        return body
    head = ",\n".join(texts[p] for p in shared)
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head},\n{body[len('WITH RECURSIVE '):]}"
    if body.startswith("WITH "):
        return f"WITH {head},\n{body[len('WITH '):]}"
    return f"WITH {head}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {name: sql(name) for name in QUERIES}
