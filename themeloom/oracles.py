"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

import re

from themeloom.queries import EXCEPTIONS, NEIGHBOURS, STOPWORDS, VERBS
from themeloom.sources.lexicons import VERB_ENDINGS

SPACES = r"[\t-\r\x1c-\x20]"
NOT_SPACES = r"[^\t-\r\x1c-\x20]"


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _values(rows) -> str:
    return ", ".join("(" + _list(r) + ")" for r in rows)


def clean(x: str) -> str:
    for pattern, to in ((r"©[^\n]*", ""), (r"(?i)keywords?:[^\n]*", ""), (r"[^\x00-\x7F]+", " "), (SPACES + "+", " ")):
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return f"trim({x})"


def words(x: str) -> str:
    """Letter-only tokens of three or more letters."""
    return (
        f"list_filter(regexp_split_to_array(regexp_replace(lower({x}), '[^a-z\\t-\\r\\x1c-\\x20]', '', 'g'), '{SPACES}+'), "
        f"lambda w: length(w) > 2)"
    )


def no_stop(x: str) -> str:
    return f"list_filter({x}, lambda w: NOT list_contains([{_list(sorted(set(STOPWORDS)))}], w))"


def word_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{NOT_SPACES}+'))"


def _tfidf(name: str, source: str) -> dict[str, str]:
    """CTEs for class counts, weights and ranked terms of ``source(topic, tokens)``."""
    return {
        f"{name}_tf": f"SELECT topic, term, count(*) AS tf FROM (SELECT topic, unnest(tokens) AS term FROM {source}) GROUP BY ALL",
        f"{name}_len": f"SELECT topic, sum(tf)::DOUBLE AS words FROM {name}_tf GROUP BY topic",
        f"{name}_all": f"SELECT term, sum(tf)::DOUBLE AS f FROM {name}_tf GROUP BY term",
        f"{name}_w": (
            f"SELECT t.topic, t.term, t.tf, t.tf / l.words * ln(1 + (SELECT avg(words) FROM {name}_len) / a.f) AS weight "
            f"FROM {name}_tf t JOIN {name}_len l USING (topic) JOIN {name}_all a USING (term)"
        ),
        f"{name}_top": (
            f"SELECT topic, rank, term, weight FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank "
            f"FROM {name}_w) WHERE rank <= 10"
        ),
        f"{name}_words": f"SELECT topic, list(term ORDER BY rank) AS words FROM {name}_top GROUP BY topic",
    }


CTES: dict[str, str] = {
    "raw": (
        "SELECT doc_id, split_part(text, chr(10), 1) AS Title, "
        "CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS Abstract FROM documents"
    ),
    "cleaned": f"SELECT doc_id, {clean('Title')} AS Title, {clean('Abstract')} AS Abstract FROM raw",
    "prep": "SELECT min(doc_id) AS doc_id, Title, Abstract FROM cleaned WHERE Title <> '' AND Abstract <> '' GROUP BY Title, Abstract",
    "docs": "SELECT doc_id, Title || ' ' || Abstract AS doc FROM prep",
    "plain_tokens": f"SELECT doc_id, {words('doc')} AS tokens FROM docs",
    "doc_tokens": f"SELECT doc_id, {no_stop('tokens')} AS tokens FROM plain_tokens",
    "given": "SELECT doc_id, substr(source, 4)::INTEGER - 1 AS topic FROM documents",
    "sizes": "SELECT doc_id, (floor(n_chars / 1000.0) - 1)::INTEGER AS topic FROM documents",
    "topic_tokens": "SELECT doc_id, topic, tokens FROM doc_tokens JOIN given USING (doc_id)",
    **_tfidf("t", "topic_tokens"),
    "title_tokens": f"SELECT topic, {no_stop(words('Title'))} AS tokens FROM prep JOIN given USING (doc_id)",
    **_tfidf("ti", "title_tokens"),
    "body_tokens": f"SELECT topic, {no_stop(words('Abstract'))} AS tokens FROM prep JOIN given USING (doc_id)",
    **_tfidf("bo", "body_tokens"),
    "turn_tokens": f"SELECT turn::INTEGER AS topic, {no_stop(words(clean('text')))} AS tokens FROM conversations",
    **_tfidf("tu", "turn_tokens"),
    "word_terms": (
        r"SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(doc), '[\p{L}\p{N}_]{2,}')) AS term FROM docs) GROUP BY term"
    ),
    "top20": f"SELECT term, n FROM word_terms WHERE term NOT IN ({_list(sorted(set(STOPWORDS)))}) ORDER BY n DESC, term LIMIT 20",
    "lengths": f"SELECT doc_id, {word_count('Abstract')} AS n_words FROM prep",
    "frequency": "SELECT topic, count(*) AS count FROM given JOIN prep USING (doc_id) GROUP BY topic",
    "plain_info": (
        "SELECT f.topic, f.count, w.words, f.topic::VARCHAR || '_' || array_to_string(w.words[1:4], '_') AS name "
        "FROM frequency f LEFT JOIN t_words w USING (topic)"
    ),
    "marked": (
        "SELECT topic, replace(replace(trim('  \"Topic''s quality ' || sum(quality)::BIGINT || '\" '), '\"', ''), '''', '') AS label "
        "FROM labels JOIN given USING (doc_id) GROUP BY topic HAVING sum(toxic) > 0 AND topic <> -1"
    ),
    # lemmas: candidates of every distinct token by the ending rules
    "verbs": f"SELECT * FROM (VALUES {_values([(v,) for v in VERBS])}) v(lemma)",
    "exceptions": f"SELECT * FROM (VALUES {_values(EXCEPTIONS)}) e(word, lemma)",
    "endings": "SELECT * FROM (VALUES " + ", ".join(
        f"({i + 1}, '{a}', '{b}')" for i, (a, b) in enumerate(VERB_ENDINGS)
    ) + ") r(rule, ending, put)",
    "token_types": "SELECT DISTINCT unnest(tokens) AS word FROM doc_tokens",
    "candidates": (
        "SELECT word, word AS lemma, 0 AS rule FROM token_types UNION ALL "
        "SELECT word, substr(word, 1, length(word) - length(ending)) || put, rule FROM token_types JOIN endings ON suffix(word, ending) "
        "WHERE word NOT IN (SELECT word FROM exceptions) UNION ALL "
        "SELECT word, e.lemma, 1 FROM token_types JOIN exceptions e USING (word)"
    ),
    "lemma_of": (
        "SELECT word, lemma FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY length(lemma), rule) AS r "
        "FROM candidates JOIN verbs USING (lemma)) WHERE r = 1"
    ),
    "token_rows": "SELECT doc_id, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM doc_tokens",
    "lemma_rows": "SELECT doc_id, pos, coalesce(l.lemma, t.token) AS token FROM token_rows t LEFT JOIN lemma_of l ON l.word = t.token",
    # documents against the term weights of their topic
    "doc_terms": "SELECT doc_id, topic, term, count(*) AS n FROM (SELECT doc_id, topic, unnest(tokens) AS term FROM topic_tokens) GROUP BY ALL",
    "topic_norms": "SELECT topic, sqrt(sum(weight * weight)) AS tn FROM t_w GROUP BY topic",
    "doc_scores": (
        "SELECT doc_id, d.topic, round(sum(n * weight) / (sqrt(sum(n::DOUBLE * n)) * any_value(tn)), 6) AS similarity "
        "FROM doc_terms d JOIN t_w USING (topic, term) JOIN topic_norms USING (topic) GROUP BY doc_id, d.topic"
    ),
    "representative": (
        "SELECT topic, rank, doc_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY similarity DESC, doc_id) AS rank "
        "FROM doc_scores) WHERE rank <= 3"
    ),
    # vectors
    "vecs": "SELECT vec_id AS doc_id, label AS topic, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings",
    "centre_cells": (
        "SELECT topic, dim, avg(x) AS value, count(*) AS n FROM "
        "(SELECT topic, unnest(range(len(e))) AS dim, unnest(e) AS x FROM vecs) GROUP BY topic, dim"
    ),
    "centres": "SELECT topic, list(value ORDER BY dim) AS c, any_value(n) AS n FROM centre_cells GROUP BY topic",
    "cosines": "SELECT v.doc_id, v.topic AS own, c.topic, round(list_cosine_similarity(e, c), 9) AS s FROM vecs v CROSS JOIN centres c",
    "cuts": "SELECT topic, quantile_disc(s, 0.05) AS cut FROM cosines WHERE own = topic GROUP BY topic",
    "nearest": (
        "SELECT doc_id, topic, s FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, topic) AS r FROM cosines) WHERE r = 1"
    ),
    "assigned": (
        "SELECT doc_id, CASE WHEN s >= cut THEN topic ELSE -1 END AS topic, round(s, 6) AS prob FROM nearest JOIN cuts USING (topic)"
    ),
    "knn": (
        "SELECT src, rank, dst, distance FROM (SELECT a.doc_id AS src, b.doc_id AS dst, round(list_distance(a.e, b.e), 6) AS distance, "
        "row_number() OVER (PARTITION BY a.doc_id ORDER BY round(list_distance(a.e, b.e), 6), b.doc_id)::INTEGER AS rank "
        f"FROM vecs a JOIN vecs b ON a.doc_id <> b.doc_id) WHERE rank <= {NEIGHBOURS}"
    ),
    "trials": (
        "SELECT substr(source, 4)::INTEGER + 4 AS min_cluster_size, CASE WHEN round(avg(quality), 6) < 0.5 THEN NULL ELSE round(avg(quality), 6) END AS score "
        "FROM documents JOIN labels USING (doc_id) GROUP BY 1"
    ),
    "stage_history": (
        "SELECT 'model-' || json_extract_string(props, '$.k') AS model_name, user_id::INTEGER AS version, "
        "CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'signup' THEN 'Staging' ELSE 'None' END AS stage, ts FROM events"
    ),
    "stages": (
        "SELECT model_name, version, stage FROM (SELECT *, row_number() OVER (PARTITION BY model_name, version ORDER BY ts DESC, stage DESC) AS r "
        "FROM stage_history) WHERE r = 1"
    ),
    "talk_tokens": f"SELECT conv_id * 1000 + turn AS doc_id, {no_stop(words(clean('text')))} AS tokens FROM conversations",
}


def _windows(name: str, source: str, top: str, size: int) -> dict[str, str]:
    """CTEs that unroll every window: joint and single probabilities of each topic's word pairs."""
    return {
        f"{name}_len": f"SELECT doc_id, tokens, len(tokens) AS n FROM {source}",
        f"{name}_total": f"SELECT sum(greatest(1, n - {size - 1}))::DOUBLE AS windows FROM {name}_len",
        f"{name}_in": (
            f"SELECT DISTINCT doc_id, term, unnest(range(greatest(0, pos - {size - 1}), least(pos, greatest(0, n - {size})) + 1)) AS w FROM "
            f"(SELECT doc_id, n, unnest(range(n)) AS pos, unnest(tokens) AS term FROM {name}_len) WHERE term IN (SELECT term FROM {top})"
        ),
        **_pair_probabilities(name, top, "doc_id, w"),
    }


def _pair_probabilities(name: str, top: str, unit: str) -> dict[str, str]:
    same = " AND ".join(f"a.{c.strip()} = b.{c.strip()}" for c in unit.split(","))
    return {
        f"{name}_words": f"SELECT topic, rank, term FROM {top} WHERE term IN (SELECT term FROM {name}_in)",
        f"{name}_both": f"SELECT a.term AS ta, b.term AS tb, count(*) AS n FROM {name}_in a JOIN {name}_in b ON {same} GROUP BY ALL",
        f"{name}_pairs": (
            f"SELECT a.topic, a.rank AS ra, b.rank AS rb, coalesce(x.n, 0) / (SELECT windows FROM {name}_total) AS p, "
            f"pa.n / (SELECT windows FROM {name}_total) AS pa, pb.n / (SELECT windows FROM {name}_total) AS pb "
            f"FROM {name}_words a JOIN {name}_words b ON a.topic = b.topic "
            f"LEFT JOIN {name}_both x ON x.ta = a.term AND x.tb = b.term "
            f"JOIN {name}_both pa ON pa.ta = a.term AND pa.tb = a.term JOIN {name}_both pb ON pb.ta = b.term AND pb.tb = b.term"
        ),
    }


CTES.update(_windows("cv", "doc_tokens", "t_top", 110))
CTES.update(_windows("np", "doc_tokens", "t_top", 10))
CTES["kept_top"] = "SELECT * FROM t_top WHERE topic <> -1"
CTES.update(_windows("tk", "talk_tokens", "kept_top", 110))
CTES["um_total"] = "SELECT count(*)::DOUBLE AS windows FROM doc_tokens"
CTES["um_in"] = (
    "SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest(tokens) AS term FROM doc_tokens) WHERE term IN (SELECT term FROM t_top)"
)
CTES.update(_pair_probabilities("um", "t_top", "doc_id"))
CTES["cv_x"] = "SELECT topic, ra, rb, ln((p + 1e-12) / (pa * pb)) / -ln(p + 1e-12) AS x FROM cv_pairs"
CTES["cv_s"] = "SELECT topic, rb, sum(x) AS s FROM cv_x GROUP BY topic, rb"
CTES["cv_cos"] = (
    "SELECT topic, ra, sum(x * s) / (sqrt(sum(x * x)) * sqrt(sum(s * s))) AS c FROM cv_x JOIN cv_s USING (topic, rb) GROUP BY topic, ra"
)
CTES["tk_x"] = "SELECT topic, ra, rb, ln((p + 1e-12) / (pa * pb)) / -ln(p + 1e-12) AS x FROM tk_pairs"
CTES["tk_s"] = "SELECT topic, rb, sum(x) AS s FROM tk_x GROUP BY topic, rb"
CTES["tk_cos"] = (
    "SELECT topic, ra, sum(x * s) / (sqrt(sum(x * x)) * sqrt(sum(s * s))) AS c FROM tk_x JOIN tk_s USING (topic, rb) GROUP BY topic, ra"
)
# re-ranking; documents without a given vector stand at the origin
CTES["rr_tokens"] = (
    "SELECT d.doc_id, g.topic, d.tokens, coalesce(v.e, [0.0 for i in range(64)]) AS e FROM doc_tokens d JOIN given g USING (doc_id) LEFT JOIN vecs v ON v.doc_id = d.doc_id"
)
CTES.update(_tfidf("rr", "rr_tokens"))
CTES["rr_cand"] = (
    "SELECT topic, term FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS r FROM rr_w) WHERE r <= 30"
)
CTES["rr_doc_terms"] = "SELECT doc_id, topic, term, count(*) AS n FROM (SELECT doc_id, topic, unnest(tokens) AS term FROM rr_tokens) GROUP BY ALL"
CTES["rr_norms"] = "SELECT topic, sqrt(sum(weight * weight)) AS tn FROM rr_w GROUP BY topic"
CTES["rr_scores"] = (
    "SELECT doc_id, d.topic, round(sum(n * weight) / (sqrt(sum(n::DOUBLE * n)) * any_value(tn)), 6) AS similarity "
    "FROM rr_doc_terms d JOIN rr_w USING (topic, term) JOIN rr_norms USING (topic) GROUP BY doc_id, d.topic"
)
CTES["rr_best"] = (
    "SELECT topic, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY similarity DESC, doc_id) AS r FROM rr_scores) WHERE r <= 3"
)
CTES["rr_cells"] = "SELECT doc_id, unnest(range(64)) AS dim, unnest(e) AS x FROM rr_tokens"
CTES["rr_tv"] = (
    "SELECT term, list(m ORDER BY dim) AS tv FROM (SELECT term, dim, avg(x) AS m FROM rr_doc_terms JOIN rr_cells USING (doc_id) "
    "WHERE term IN (SELECT term FROM rr_cand) GROUP BY term, dim) GROUP BY term"
)
CTES["rr_cv"] = (
    "SELECT topic, list(m ORDER BY dim) AS cv FROM (SELECT topic, dim, avg(x) AS m FROM rr_best JOIN rr_cells USING (doc_id) "
    "GROUP BY topic, dim) GROUP BY topic"
)

TITLE_FROM_WORDS = "array_to_string(list_transform({}, lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
LABEL_WORDS = (
    "CASE WHEN len(list_filter(words[1:5], lambda w: w NOT IN ('research', 'study', 'analysis', 'method', 'based', 'data', 'system'))) >= 3 "
    "THEN list_filter(words[1:5], lambda w: w NOT IN ('research', 'study', 'analysis', 'method', 'based', 'data', 'system'))[1:4] ELSE words[1:4] END"
)
UNIQUE_WORDS = (
    "array_to_string(list_filter(ws, lambda w, i: list_position(list_transform(ws, lambda x: lower(x)), lower(w)) = i), '|')"
)
LEVEL = "CASE WHEN {0} < 0.4 THEN 'HIGH' WHEN {0} < 0.6 THEN 'MEDIUM' ELSE 'LOW' END"
JACCARD = (
    "CASE WHEN coalesce(len({0}), 0) > 0 AND coalesce(len({1}), 0) > 0 "
    "THEN len(list_intersect({0}, {1}))::DOUBLE / len(list_distinct(list_concat({0}, {1}))) ELSE 0.0 END"
)
SIZE_LOW = "CASE WHEN n < 200 THEN 4 WHEN n < 500 THEN 5 WHEN n < 1000 THEN 10 WHEN n < 1500 THEN 13 WHEN n < 2500 THEN 16 ELSE 20 END"
SIZE_PAST = "CASE WHEN n < 200 THEN 10 WHEN n < 500 THEN 15 WHEN n < 1000 THEN 25 WHEN n < 1500 THEN 30 WHEN n < 2500 THEN 35 ELSE 50 END"
CORPORA = " UNION ALL ".join(
    ["SELECT lang AS corpus, count(*) AS n FROM documents GROUP BY lang"]
    + [f"SELECT '{t}', count(*) FROM {t}" for t in ("documents", "embeddings", "conversations", "orders", "customer")]
)


def _window_sql(starts: str, hours: int) -> str:
    return (
        f"SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL {hours} HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, "
        f"event_type, count(*) AS n FROM (SELECT event_type, {starts} AS s FROM events) GROUP BY ALL"
    )


SELECTS: dict[str, str] = {
    "scan_documents": "SELECT doc_id, text FROM documents",
    "experiment_log": "SELECT source, count(*)::DOUBLE AS n_documents, round(avg(n_chars), 6) AS mean_chars FROM documents GROUP BY source",
    "stopword_profile": (
        f"SELECT word, coalesce(n, 0) AS n FROM (SELECT unnest([{_list(sorted(set(STOPWORDS)))}]) AS word) "
        "LEFT JOIN word_terms ON term = word"
    ),
    "clean_text": f"SELECT doc_id, {clean('text')} AS text FROM documents",
    "clean_documents": "SELECT doc_id, Title, Abstract FROM cleaned",
    "dedup_documents": "SELECT min(doc_id) AS doc_id, text, lang FROM documents GROUP BY text, lang",
    "preprocess": "SELECT doc_id, Title, Abstract FROM prep",
    "combine_docs": "SELECT doc_id, doc FROM docs",
    "topic_list": "SELECT topic, name AS label, count AS n_documents FROM plain_info WHERE topic <> -1",
    "topic_documents": "SELECT doc_id, Title AS title, substr(Abstract, 1, 400) || '...' AS summary, topic FROM prep JOIN given USING (doc_id)",
    "valid_topics": "SELECT topic, count(*) AS count FROM sizes WHERE topic <> -1 GROUP BY topic HAVING count(*) >= 3",
    "sample_documents": "SELECT doc_id, source FROM documents ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id LIMIT 5000",
    "tokenize": "SELECT doc_id, array_to_string(tokens, ' ') AS tokens, len(tokens) AS n FROM plain_tokens",
    "tokens_no_stopwords": (
        "SELECT doc_id, pos::INTEGER AS pos, token FROM (SELECT doc_id, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM plain_tokens) "
        f"WHERE token NOT IN ({_list(sorted(set(STOPWORDS)))})"
    ),
    "lemmatize": "SELECT token AS lemma, count(*) AS n FROM lemma_rows GROUP BY token",
    "simple_tokenizer": (
        "SELECT doc_id, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS tokens FROM docs LEFT JOIN lemma_rows USING (doc_id) GROUP BY doc_id"
    ),
    "vocabulary": (
        "SELECT token, count(DISTINCT doc_id) AS df, count(*) AS cf FROM (SELECT doc_id, unnest(tokens) AS token FROM doc_tokens) GROUP BY token"
    ),
    "term_counts": (
        r"SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents) "
        f"WHERE term NOT IN ({_list(sorted(set(STOPWORDS)))}) GROUP BY term"
    ),
    "ngrams": (
        "SELECT doc_id, len(g) AS n, len(list_distinct(g)) AS n_distinct, list_min(g) AS first_term, list_max(g) AS last_term FROM "
        "(SELECT doc_id, list_concat(list_concat(tokens, "
        "list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])), "
        "list_transform(range(1, len(tokens) - 1), lambda i: tokens[i] || ' ' || tokens[i + 1] || ' ' || tokens[i + 2])) AS g FROM doc_tokens)"
    ),
    "profile_basic": "SELECT count(*) AS total_records, 'doc_id,text,lang,source,n_chars' AS columns FROM documents",
    "profile_nulls": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM documents LEFT JOIN labels USING (doc_id)"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "profile_duplicates": (
        "SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS duplicates"
    ),
    "text_statistics": (
        f"SELECT round(avg({word_count('Abstract')}), 6) AS mean_word_count, max({word_count('Abstract')}) AS max_word_count, "
        f"min({word_count('Abstract')}) AS min_word_count, round(avg(length(Abstract)), 6) AS mean_char_count FROM prep"
    ),
    "doc_lengths": "SELECT doc_id, n_words FROM lengths",
    "length_histogram": (
        "SELECT b::INTEGER AS bin, round(lo + b * w, 6) AS bin_start, round(lo + (b + 1) * w, 6) AS bin_end, coalesce(n, 0) AS n FROM "
        "(SELECT unnest(range(30)) AS b, lo, (hi - lo) / 30 AS w FROM (SELECT min(n_words)::DOUBLE AS lo, max(n_words)::DOUBLE AS hi FROM lengths)) LEFT JOIN "
        "(SELECT least(floor((n_words - lo) * 30 / (hi - lo)), 29)::BIGINT AS b, count(*) AS n FROM lengths, "
        "(SELECT min(n_words)::DOUBLE AS lo, max(n_words)::DOUBLE AS hi FROM lengths) GROUP BY 1) USING (b)"
    ),
    "length_density": (
        "SELECT point::INTEGER AS point, round(any_value(x), 6) AS length, round(sum(exp(-0.5 * ((x - n_words) / h) * ((x - n_words) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density "
        "FROM (SELECT point, lo + point * (hi - lo) / 199 AS x, h, n FROM (SELECT unnest(range(200)) AS point, min(n_words)::DOUBLE AS lo, "
        "max(n_words)::DOUBLE AS hi, stddev_samp(n_words) * pow(count(*), -0.2) AS h, count(*) AS n FROM lengths)), lengths GROUP BY point"
    ),
    "top_words": "SELECT term, n, row_number() OVER (ORDER BY n DESC, term) <= 15 AS in_chart FROM top20",
    "wordcloud_weights": (
        "SELECT term, n, round(n / max(n) OVER (), 6) AS weight FROM (SELECT term, n FROM word_terms "
        f"WHERE term NOT IN ({_list(sorted(set(STOPWORDS)))}) ORDER BY n DESC, term LIMIT 100)"
    ),
    "topic_frequency": "SELECT topic, count(*) AS count FROM sizes GROUP BY topic",
    "topic_count": "SELECT count(DISTINCT topic) AS n_topics FROM sizes WHERE topic <> -1",
    "assigned_topic_count": "SELECT count(DISTINCT topic) AS n_topics FROM sizes",
    "eda_report": (
        "WITH terms_raw AS (SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(Title || ' ' || Abstract), '[\\p{L}\\p{N}_]{2,}')) AS term FROM raw) "
        f"WHERE term NOT IN ({_list(sorted(set(STOPWORDS)))}) GROUP BY term ORDER BY n DESC, term LIMIT 20) "
        "SELECT (SELECT count(*) FROM raw) AS total_records, 'Title,Abstract' AS columns, "
        "(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT Title, Abstract FROM raw)) AS duplicates, "
        "'Abstract' AS text_column, 0::BIGINT AS missing_abstract, "
        f"round(avg({word_count('Abstract')}), 6) AS mean_word_count, max({word_count('Abstract')}) AS max_word_count, "
        f"min({word_count('Abstract')}) AS min_word_count, round(avg(length(Abstract)), 6) AS mean_char_count, "
        "(SELECT string_agg(term || ':' || n, ' ' ORDER BY n DESC, term) FROM terms_raw) AS top_words FROM raw"
    ),
    "jaccard": (
        f"SELECT doc_id, round({JACCARD.format('a', 'b')}, 6) AS similarity FROM "
        f"(SELECT doc_id, ({words('Title')})[1:10] AS a, ({words('Abstract')})[1:10] AS b FROM prep)"
    ),
    "representation_words": (
        f"SELECT doc_id, (SELECT {UNIQUE_WORDS} FROM (SELECT string_split(array_to_string(t, ','), ',') AS ws) WHERE len(t) > 0) AS as_string, "
        f"(SELECT {UNIQUE_WORDS} FROM (SELECT t AS ws)) AS as_array, (SELECT {UNIQUE_WORDS} FROM (SELECT t AS ws)) AS as_pairs "
        f"FROM (SELECT doc_id, regexp_extract_all(Title, '{NOT_SPACES}+') AS t FROM prep)"
    ),
    "simple_labels": f"SELECT topic, {TITLE_FROM_WORDS.format('(' + LABEL_WORDS + ')')} AS label FROM t_words WHERE topic <> -1",
    "title_case": (
        r"SELECT doc_id, array_to_string(list_transform(regexp_extract_all(Title, '[A-Za-z]+|[^A-Za-z]+'), "
        "lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '') AS title FROM prep"
    ),
    "topic_names": "SELECT topic, topic::VARCHAR || '_' || array_to_string(words[1:4], '_') AS name FROM t_words",
    "label_keywords": "SELECT topic, array_to_string(words[1:8], ' ') AS keywords FROM t_words",
    "topic_labels": "SELECT topic, coalesce(label, name) AS name FROM plain_info LEFT JOIN marked USING (topic)",
    "topic_display_names": "SELECT topic, 'Topik ' || topic || ': ' || name AS display FROM plain_info WHERE topic <> -1",
    "renumber_topics": (
        "SELECT s.doc_id, coalesce(r.new, -1)::INTEGER AS topic FROM sizes s LEFT JOIN (SELECT topic, row_number() OVER (ORDER BY n DESC, first) - 1 AS new "
        "FROM (SELECT topic, count(*) AS n, min(doc_id) AS first FROM sizes WHERE topic <> -1 GROUP BY topic)) r USING (topic)"
    ),
    "class_tf": "SELECT topic, term, tf FROM t_tf",
    "ctfidf": "SELECT topic, term, tf, round(weight, 9) AS weight FROM t_w",
    "topic_top_words": "SELECT topic, rank::INTEGER AS rank, term, round(weight, 9) AS weight FROM t_top",
    "representative_docs": "SELECT topic, rank::INTEGER AS rank, doc_id, similarity FROM representative",
    "topic_info": (
        "SELECT p.topic, p.count, coalesce(m.label, p.name) AS name, array_to_string(p.words, ' ') AS representation, r.docs AS representative_docs "
        "FROM plain_info p LEFT JOIN marked m USING (topic) LEFT JOIN (SELECT topic, string_agg(doc_id::VARCHAR, ' ' ORDER BY rank) AS docs "
        "FROM representative GROUP BY topic) r USING (topic)"
    ),
    "rerank_keywords": (
        "SELECT topic, rank::INTEGER AS rank, term, weight FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM "
        "(SELECT topic, term, round(coalesce(nullif(list_cosine_similarity(tv, cv), 'nan'::DOUBLE), 0.0), 6) + 0.0 AS weight FROM rr_cand JOIN rr_tv USING (term) JOIN rr_cv USING (topic))) WHERE rank <= 10"
    ),
    "embed_precomputed": (
        "SELECT doc_id, coalesce(len(e), 64) AS width, round(coalesce(list_sum(e), 0.0), 6) AS total FROM docs LEFT JOIN vecs USING (doc_id)"
    ),
    "embed_documents": (
        "WITH counts AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM doc_tokens) GROUP BY ALL), "
        "signs AS (SELECT term, dim, CASE WHEN substr(md5(term || ':' || (dim // 32)), dim % 32 + 1, 1) >= '8' THEN 1 ELSE -1 END AS s "
        "FROM (SELECT DISTINCT term FROM counts), (SELECT unnest(range(64)) AS dim)), "
        "sums AS (SELECT doc_id, dim, sum(n * s)::DOUBLE AS x FROM counts JOIN signs USING (term) GROUP BY ALL), "
        "lens AS (SELECT doc_id, sqrt(sum(x * x)) AS len FROM sums GROUP BY doc_id) "
        "SELECT d.doc_id, d.dim::INTEGER AS dim, round(CASE WHEN len > 0 THEN x / len ELSE 0 END, 6) + 0.0 AS value FROM "
        "(SELECT doc_id, unnest(range(64)) AS dim FROM docs) d LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.dim = d.dim LEFT JOIN lens l ON l.doc_id = d.doc_id"
    ),
    "knn_graph": "SELECT src, rank, dst, distance FROM knn",
    "mutual_reachability": (
        "SELECT u, v, greatest(d, a.core, b.core) AS w FROM (SELECT least(src, dst) AS u, greatest(src, dst) AS v, min(distance) AS d FROM knn GROUP BY ALL) "
        f"JOIN (SELECT src, distance AS core FROM knn WHERE rank = {NEIGHBOURS}) a ON a.src = u JOIN (SELECT src, distance AS core FROM knn WHERE rank = {NEIGHBOURS}) b ON b.src = v"
    ),
    "topic_centroids": "SELECT topic, n, dim::INTEGER AS dim, round(value, 6) AS value FROM centre_cells",
    "assign_topics": "SELECT doc_id, topic, prob FROM assigned",
    "stream_assign": "SELECT doc_id, topic, prob FROM assigned",
    "topic_probabilities": (
        "SELECT doc_id, topic, round(exp(s) / sum(exp(s)) OVER (PARTITION BY doc_id), 6) AS prob FROM "
        "(SELECT v.doc_id, c.topic, list_cosine_similarity(e, c) AS s FROM vecs v CROSS JOIN centres c)"
    ),
    "coherence_cv": "SELECT topic, round(avg(c), 6) + 0.0 AS coherence FROM cv_cos GROUP BY topic",
    "coherence_umass": "SELECT topic, round(avg(ln((p + 1e-12) / pb)), 6) + 0.0 AS coherence FROM um_pairs WHERE ra > rb GROUP BY topic",
    "coherence_npmi": (
        "SELECT topic, round(avg(ln((p + 1e-12) / (pa * pb)) / -ln(p + 1e-12)), 6) + 0.0 AS coherence FROM np_pairs WHERE ra > rb GROUP BY topic"
    ),
    "coherence_uci": "SELECT topic, round(avg(ln((p + 1e-12) / (pa * pb))), 6) + 0.0 AS coherence FROM np_pairs WHERE ra > rb GROUP BY topic",
    "inference_coherence": (
        "SELECT round(CASE WHEN count(*) >= 2 THEN avg(c) ELSE 0.0 END, 6) AS coherence_score, count(*) AS n_topics FROM "
        "(SELECT topic, avg(c) AS c FROM tk_cos GROUP BY topic)"
    ),
    "best_trial": (
        "SELECT min_cluster_size AS best_min_cluster, score AS best_coherence FROM trials WHERE score IS NOT NULL ORDER BY score DESC, min_cluster_size LIMIT 1"
    ),
    "select_min_cluster": (
        "SELECT coalesce((SELECT min_cluster_size FROM trials WHERE score IS NOT NULL ORDER BY score DESC, min_cluster_size LIMIT 1), min(min_cluster_size)) AS min_cluster_size, "
        "coalesce(max(score), 0.0) AS coherence_score FROM trials"
    ),
    "trial_grid": (
        f"WITH ranges AS (SELECT corpus, n, range({SIZE_LOW}, {SIZE_PAST}) AS sizes FROM ({CORPORA})) "
        "SELECT corpus, n, unnest(CASE WHEN len(sizes) > 15 THEN list_transform(range(15), lambda i: sizes[(floor(i * (len(sizes) - 1) / 14) + 1)::INTEGER]) ELSE sizes END)::INTEGER AS min_cluster_size FROM ranges"
    ),
    "drift_topics": (
        f"SELECT a.topic, round({JACCARD.format('a.words', 'b.words')}, 6) AS similarity FROM ti_words a LEFT JOIN bo_words b ON a.topic = b.topic"
    ),
    "drift_summary": (
        f"WITH s AS (SELECT a.topic, {JACCARD.format('a.words', 'b.words')} AS similarity FROM t_words a LEFT JOIN tu_words b ON a.topic = b.topic), "
        "m AS (SELECT coalesce(avg(similarity), 0.0) AS mean, coalesce(min(similarity), 0.0) AS low, "
        "string_agg(topic || ':' || round(similarity, 3)::VARCHAR, ' ' ORDER BY topic) AS entries FROM s) "
        f"SELECT round(mean, 6) AS mean_similarity, round(low, 6) AS min_similarity, entries AS topic_similarities, mean < 0.6 AS has_drift, {LEVEL.format('mean')} AS drift_level FROM m"
    ),
    "latest_drift": (
        "SELECT event_type AS model_name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, round(least(1.0, value / 100), 6) AS mean_similarity, "
        f"{LEVEL.format('least(1.0, value / 100)')} AS drift_level FROM "
        "(SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS r FROM events) WHERE r = 1"
    ),
    "performance_log": (
        "WITH daily AS (SELECT ts::DATE AS day, count(*) AS n, count(DISTINCT event_type) AS k, "
        "round(avg(CASE WHEN value > 5000 THEN 1.0 ELSE 0.0 END), 6) AS score, round(avg(value) / 100, 6) AS mean FROM events GROUP BY 1) "
        "SELECT strftime(day, '%Y-%m-%d') AS day, n AS n_documents, k AS n_topics, 0.5::DOUBLE AS inference_time_sec, nullif(score, 0) AS coherence_score, "
        f"mean < 0.6 AS drift_detected, {LEVEL.format('mean')} AS drift_level, 'topic-model' AS model_name FROM daily"
    ),
    "model_stages": "SELECT model_name, version, stage FROM stages",
    "resolve_model": (
        "SELECT model_name, coalesce(max(version) FILTER (WHERE stage = 'Production'), max(version)) AS version FROM stages GROUP BY model_name"
    ),
    "window_counts_tumbling": _window_sql("date_trunc('day', ts)", 24),
    "window_counts_sliding": _window_sql("unnest(list_transform(range(4), lambda i: time_bucket(INTERVAL 6 HOUR, ts) - i::INTEGER * INTERVAL 6 HOUR))", 24),
    "window_counts_session": (
        "WITH marked_events AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR >= ts THEN 0 ELSE 1 END AS fresh FROM events), "
        "numbered AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked_events) "
        "SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS window_start, strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, user_id, count(*) AS n "
        "FROM numbered GROUP BY user_id, s"
    ),
}

SELECTS.update({f"stream_counts_{k}": SELECTS[f"window_counts_{k}"] for k in ("tumbling", "sliding", "session")})


def _hash_vectors(source: str) -> str:
    """Hashed projections of ``source(doc_id, tokens)`` as ``(doc_id, e)``."""
    return (
        f"SELECT d.doc_id, list(CASE WHEN len > 0 THEN coalesce(x, 0) / len ELSE 0.0 END ORDER BY d.dim) AS e FROM "
        f"(SELECT doc_id, unnest(range(64)) AS dim FROM {source}) d LEFT JOIN "
        "(SELECT doc_id, dim, sum(n * CASE WHEN substr(md5(term || ':' || (dim // 32)), dim % 32 + 1, 1) >= '8' THEN 1 ELSE -1 END)::DOUBLE AS x "
        f"FROM (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM {source}) GROUP BY ALL), "
        "(SELECT unnest(range(64)) AS dim) GROUP BY doc_id, dim) s ON s.doc_id = d.doc_id AND s.dim = d.dim "
        "LEFT JOIN (SELECT doc_id, sqrt(sum(x * x)) AS len FROM (SELECT doc_id, dim, "
        "sum(n * CASE WHEN substr(md5(term || ':' || (dim // 32)), dim % 32 + 1, 1) >= '8' THEN 1 ELSE -1 END)::DOUBLE AS x "
        f"FROM (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM {source}) GROUP BY ALL), "
        "(SELECT unnest(range(64)) AS dim) GROUP BY doc_id, dim) GROUP BY doc_id) l ON l.doc_id = d.doc_id GROUP BY d.doc_id"
    )


# a model with given topics, serving the benchmark texts
CTES["unseen_tokens"] = f"SELECT item_id AS doc_id, {no_stop(words(clean('text')))} AS tokens FROM benchmark"
CTES["unseen_vecs"] = _hash_vectors("unseen_tokens")
CTES["own_vecs"] = _hash_vectors("doc_tokens")
CTES["own_topics"] = "SELECT v.doc_id, g.topic, v.e FROM own_vecs v JOIN given g USING (doc_id) WHERE g.topic <> -1"
CTES["own_centres"] = (
    "SELECT topic, list(m ORDER BY dim) AS c FROM (SELECT topic, dim, avg(x) AS m FROM "
    "(SELECT topic, unnest(range(64)) AS dim, unnest(e) AS x FROM own_topics) GROUP BY topic, dim) GROUP BY topic"
)


def _cosine(a: str, b: str) -> str:
    return f"round(coalesce(nullif(list_cosine_similarity({a}, {b}), 'nan'::DOUBLE), 0.0), 9)"


CTES["own_cuts"] = f"SELECT topic, quantile_disc({_cosine('e', 'c')}, 0.05) AS cut FROM own_topics JOIN own_centres USING (topic) GROUP BY topic"
CTES["unseen_nearest"] = (
    "SELECT doc_id, topic, s FROM (SELECT doc_id, topic, s, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, topic) AS r FROM "
    f"(SELECT v.doc_id, c.topic, {_cosine('e', 'c')} AS s FROM unseen_vecs v CROSS JOIN own_centres c)) WHERE r = 1"
)
SERVED = (
    "SELECT doc_id, CASE WHEN s >= cut THEN topic ELSE -1 END AS topic, round(s, 6) AS prob FROM unseen_nearest JOIN own_cuts USING (topic)"
)
SELECTS["stream_assign_documents"] = SELECTS["monitored_inference"] = SERVED
N_GIVEN = "(SELECT count(DISTINCT topic) FROM docs JOIN given USING (doc_id))"
SELECTS["model_versions"] = (
    f"SELECT 'topic-model' AS model_name, v AS version, stage, score AS coherence_score, {N_GIVEN}::VARCHAR AS n_topics "
    "FROM (VALUES (1, 'Production', 0.5::DOUBLE), (2, 'Staging', 0.6::DOUBLE)) t(v, stage, score)"
)
SELECTS["performance_report"] = (
    f"SELECT (SELECT count(*) FROM benchmark) AS n_documents, {N_GIVEN} AS n_topics, false AS drift_detected, 'LOW' AS drift_level, 'topic-model' AS model_name"
)
SELECTS["monitoring_dashboard"] = (
    "SELECT 'topic-model' AS model_name, 'LOW' AS drift_level, 1 AS n_drift, (count(DISTINCT topic) >= 2)::INTEGER AS n_coherence, 1 AS n_runs "
    f"FROM ({SERVED})"
)
SELECTS["coherence_trend"] = f"SELECT count(DISTINCT topic) AS n_topics, 'topic-model' AS model_name FROM ({SERVED})"


def oracle(name: str) -> str:
    """The select with the common table expressions it needs."""
    body = SELECTS[name]
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_][a-z_0-9]*", text)):
            if word in CTES and word not in needed:
                needed.add(word)
                visit(CTES[word])

    visit(body)
    prelude = ", ".join(f"{n} AS ({CTES[n]})" for n in _ordered(needed))
    if not prelude:
        return body
    if body.startswith("WITH "):
        return f"WITH {prelude}, {body[5:]}"
    return f"WITH {prelude} {body}"


def _ordered(needed: set[str]) -> list[str]:
    """Definitions before uses."""
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        for word in re.findall(r"[a-z_][a-z_0-9]*", CTES[name]):
            if word in needed and word != name:
                place(word)
        order.append(name)

    for name in CTES:
        if name in needed:
            place(name)
    return order


def oracles() -> dict[str, str]:
    return {name: oracle(name) for name in SELECTS}
