"""DuckDB SQL twins of the named queries (the correctness oracle).

Each string is self-contained: the ``WITH`` clause re-derives ``posts`` from
the ``events`` and ``documents`` views with the same rule as
``sources.posts`` and then follows the same operator chain.
"""

from __future__ import annotations

from tagpulse.functions.lexicon import NEGATIVE, POSITIVE, STOP, default_lexicon
from tagpulse.functions.text import matchable_words
from tagpulse.operators.intervals import NO_INTERVALS_MESSAGE
from tagpulse.operators.language import NON_LETTER_RUN
from tagpulse.plans.catalog import EDIT, EDITED, EDITED_AGAIN, LATE_EDIT, PREVIEW_ROWS, REPLAYED, RESTORED, SERVING_HASHTAG
from tagpulse.sources.posts import POLARITY_WORDS

_LEX = default_lexicon()

# The rules in words of their own, not the engine's patterns: posts hold no line break after ingest.
_SPACE = r"[ \t\n\x0B\f\r]"
_FIRST_TAG = rf"{_SPACE}(#[0-9A-Za-z_]+)"
EDGE_SPACE_PATTERN, TOKEN_SEPARATOR = rf"^{_SPACE}+|{_SPACE}+$", rf"{_SPACE}+"
NON_LETTER_PATTERN = r"[^a-zA-Z \t\n\x0B\f\r]"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(words) -> str:
    return "(" + ", ".join(_quote(w) for w in matchable_words(words)) + ")"


def _padded_words(text: str) -> str:
    return f"' ' || trim(regexp_replace(lower({text}), '{NON_LETTER_RUN}', ' ', 'g')) || ' '"


# Trigrams of a column ``c`` that holds the padded words split into characters.
_TRIGRAMS_OF_C = ("list_filter(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2]), "
                  "lambda g: substring(g, 2, 1) <> ' ')")


_CLEAN = (f"lower(regexp_replace(regexp_replace(text, '{NON_LETTER_PATTERN}', '', 'g'), "
          f"'{EDGE_SPACE_PATTERN}', '', 'g'))")
_TOKENS = f"regexp_split_to_array(text, '{TOKEN_SEPARATOR}')"


def _batch_chain(suffix: str, source: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """cleaned -> stemmed -> counted -> scored -> sentiment over ``source``."""
    n = {k: k + suffix for k in ("cleaned", "cleaned_ok", "stemmed", "counted", "scored", "sentiment")}
    return {
        n["cleaned"]: ((source,), f"SELECT id, {_CLEAN} AS text FROM {source} WHERE text IS NOT NULL"),
        n["cleaned_ok"]: ((n["cleaned"],), f"SELECT id, text FROM {n['cleaned']} WHERE length(text) > 0"),
        # P8 token by token: the first, the last and every token that is no stop word stay; neighbours keep
        # the white space between them, others get one space.
        n["stemmed"]: ((n["cleaned_ok"],), f"""
            SELECT id, array_to_string(list_transform(range(1, len(kept) + 1), lambda k:
                     (CASE WHEN k = 1 THEN '' WHEN kept[k] = kept[k - 1] + 1 THEN gaps[kept[k] - 1] ELSE ' ' END) || parts[kept[k]]), '') AS text
            FROM (SELECT id, parts, gaps, list_filter(range(1, len(parts) + 1),
                           lambda i: i = 1 OR i = len(parts) OR parts[i] NOT IN {_in_list(_LEX.words(STOP))}) AS kept
                  FROM (SELECT id, {_TOKENS} AS parts, regexp_extract_all(text, '{TOKEN_SEPARATOR}') AS gaps FROM {n['cleaned_ok']}))"""),
        n["counted"]: ((n["stemmed"],), f"""
            SELECT id, text,
                   CAST(len({_TOKENS}) AS BIGINT) AS n_tokens,
                   CAST(len(list_filter({_TOKENS}, lambda w: w IN {_in_list(_LEX.words(POSITIVE))})) AS BIGINT)
                     AS pos_hits,
                   CAST(len(list_filter({_TOKENS}, lambda w: w IN {_in_list(_LEX.words(NEGATIVE))})) AS BIGINT)
                     AS neg_hits
            FROM {n['stemmed']}"""),
        n["scored"]: ((n["counted"],), f"""
            SELECT *, CAST(CAST(pos_hits AS DOUBLE) / n_tokens AS FLOAT) AS pos_score,
                      CAST(CAST(neg_hits AS DOUBLE) / n_tokens AS FLOAT) AS neg_score
            FROM {n['counted']}"""),
        n["sentiment"]: ((n["scored"],), f"""
            SELECT _id, r.text AS text, r.sentiment AS sentiment FROM (
              SELECT _id, min(struct_pack(text := text, sentiment := sentiment)) AS r FROM (
                SELECT id AS _id, text,
                       CASE WHEN pos_score > neg_score THEN 'positive'
                            WHEN pos_score < neg_score THEN 'negative' ELSE 'neutral' END AS sentiment
                FROM {n['scored']})
              GROUP BY _id)"""),
    }


# name -> (dependencies, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "nd": ((), "SELECT count(*) AS n FROM documents"),
    "ev": ((), "SELECT event_id, ts, event_type, "
                "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
    "raw_posts": (("nd", "ev"), f"""
        SELECT CAST(ev.event_id AS VARCHAR) AS id, d.lang AS lang,
               (CASE WHEN ev.k % 10 = 0 THEN '#' || ev.event_type || ' ' ELSE '' END)
               || d.text
               || (CASE ev.k % 4 WHEN 0 THEN {_quote(POLARITY_WORDS[0])} WHEN 1 THEN {_quote(POLARITY_WORDS[1])}
                                 WHEN 2 THEN {_quote(POLARITY_WORDS[2])} ELSE {_quote(POLARITY_WORDS[3])} END)
               || (CASE WHEN ev.k % 10 IN (0, 1) THEN 'none' ELSE '#' || ev.event_type || ' #extra' END) AS text,
               strftime(ev.ts, '%a %b %d %H:%M:%S UTC %Y') AS created
        FROM (SELECT ev.*, ev.event_id % nd.n AS doc_key FROM ev, nd) ev
        JOIN documents d ON d.doc_id = ev.doc_key"""),
    "posts": (("raw_posts",), """
        SELECT id, lang, replace(replace(text, chr(10), ' '), ':', '') AS text,
               replace(replace(created, chr(10), ' '), ':', '') AS created
        FROM raw_posts"""),
    "payload": (("posts",), """
        SELECT id AS key, json_object('id', id, 'text', text, 'created', created) AS value FROM posts"""),
    "tagged": (("posts",), f"""
        SELECT *, regexp_extract(text, '{_FIRST_TAG}', 1) AS hashtag FROM posts"""),
    "summary": (("tagged",), """
        SELECT id AS _id, hashtag, created AS time FROM tagged WHERE hashtag <> ''"""),
    "archive": (("posts",), f"""
        SELECT * FROM posts WHERE regexp_matches(text, '{_FIRST_TAG}')"""),
    "english": (("archive",), "SELECT id, text FROM archive WHERE lang = 'en'"),
    "timed": (("summary",), """
        SELECT _id, hashtag, time,
               COALESCE(CAST(epoch(try_strptime(time, '%a %b %d %H%M%S %Z %Y')) AS BIGINT), 0) AS timestamp
        FROM summary"""),
    "joined": (("timed", "sentiment"), """
        SELECT t._id, t.hashtag, t.timestamp, s.sentiment
        FROM timed t JOIN (SELECT _id, min(sentiment) AS sentiment FROM sentiment GROUP BY _id) s
          ON t._id = s._id"""),
    "marked": (("joined",), """
        SELECT *, CAST(sentiment <> 'positive' AS BIGINT) AS np FROM joined"""),
    "islands": (("marked",), """
        SELECT *, COALESCE(SUM(np) OVER (PARTITION BY hashtag ORDER BY timestamp, _id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island
        FROM marked"""),
    "intervals": (("islands",), """
        SELECT hashtag, min(timestamp) AS start_ts, max(timestamp) AS end_ts,
               max(timestamp) - min(timestamp) AS seconds, CAST(count(*) - 1 AS BIGINT) AS tweets
        FROM islands GROUP BY hashtag, island
        HAVING sum(np) = 1 AND count(*) > 1"""),
    "doc_grams": ((), f"""
        SELECT lang, unnest({_TRIGRAMS_OF_C}) AS gram
        FROM (SELECT lang, string_split({_padded_words('text')}, '') AS c FROM documents WHERE lang IS NOT NULL)"""),
    "profiles": (("doc_grams",), "SELECT lang, gram, count(*) AS n FROM doc_grams GROUP BY lang, gram"),
    "profile_side": (("profiles",), """
        SELECT p.gram, p.lang, p.n, m.norm2 FROM profiles p
        JOIN (SELECT lang, sum(CAST(n AS DOUBLE) * n) AS norm2 FROM profiles GROUP BY lang) m ON p.lang = m.lang"""),
    "post_grams": (("archive",), f"""
        SELECT id, unnest({_TRIGRAMS_OF_C}) AS gram
        FROM (SELECT id, string_split({_padded_words('text')}, '') AS c FROM archive)"""),
    "detected": (("post_grams", "profile_side"), """
        SELECT id, lang FROM (
          SELECT id, lang, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang DESC) AS rn
          FROM (SELECT g.id, p.lang, CAST(sum(p.n) AS DOUBLE) / sqrt(max(p.norm2)) AS score
                FROM post_grams g JOIN profile_side p ON g.gram = p.gram GROUP BY g.id, p.lang))
        WHERE rn = 1"""),
    # What each batch of the keyed view says, in the order of batches; the last word counts.
    "upserts": (("summary",), f"""
        SELECT 0 AS batch, _id, hashtag, time FROM summary WHERE CAST(_id AS BIGINT) % 3 <> 2
        UNION ALL SELECT 1, _id, hashtag, time FROM summary WHERE CAST(_id AS BIGINT) % 3 = 2 OR CAST(_id AS BIGINT) % {REPLAYED} = 0
        UNION ALL SELECT 2, _id, {_quote(EDIT)}, time FROM summary WHERE CAST(_id AS BIGINT) % {EDITED} = 0
        UNION ALL SELECT 3, _id, hashtag, time FROM summary WHERE CAST(_id AS BIGINT) % {RESTORED} = 0 AND CAST(_id AS BIGINT) % {EDITED_AGAIN} <> 0
        UNION ALL SELECT 3, _id, {_quote(LATE_EDIT)}, time FROM summary WHERE CAST(_id AS BIGINT) % {EDITED_AGAIN} = 0"""),
    "damaged": (("posts",), """
        SELECT id AS key, CASE CAST(id AS BIGINT) % 20 WHEN 3 THEN 'no json ' || id WHEN 7 THEN CAST(json_object('id', id, 'created', created) AS VARCHAR)
                               WHEN 11 THEN CAST(json_object('text', text, 'created', created) AS VARCHAR) END AS value,
               CASE CAST(id AS BIGINT) % 20 WHEN 3 THEN 'no object' WHEN 7 THEN 'no text' WHEN 11 THEN 'no id' ELSE 'no value' END AS reason
        FROM posts WHERE CAST(id AS BIGINT) % 20 IN (3, 7, 11, 13)"""),
    "dated": (("archive",), """
        SELECT json_object('id', id, 'text', text, 'created', created) AS value,
               CAST(CAST(try_strptime(created, '%a %b %d %H%M%S %Z %Y') AS DATE) AS VARCHAR) AS date FROM archive"""),
    # Batch layer fed by detected English instead of the lang column.
    "english_d": (("archive", "detected"), """
        SELECT id, text FROM archive
        WHERE id IN (SELECT id FROM detected WHERE lang = 'en')"""),
}
_CTES.update(_batch_chain("", "english"))
_CTES.update(_batch_chain("_d", "english_d"))


def _with(final: str, *roots: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _CTES[name][0]:
            visit(dep)
        order.append(name)

    for root in roots:
        visit(root)
    ctes = ",\n".join(f"{name} AS ({_CTES[name][1].strip()})" for name in order)
    return f"WITH {ctes}\n{final.strip()}"


_REPORT = f"""
SELECT t.hashtag, i.start_ts,
       CASE WHEN i.seconds IS NULL THEN {_quote(NO_INTERVALS_MESSAGE)}
            ELSE chr(10) || 'Hashtag:   ' || t.hashtag || chr(10)
                 || 'Interval between a positive tweet and a neutral/negative tweet:   '
                 || CAST(i.seconds AS VARCHAR) || ' seconds' || chr(10)
                 || 'Number of tweets within the interval:   ' || CAST(i.tweets AS VARCHAR) || ' tweets'
       END AS message
FROM (SELECT DISTINCT hashtag FROM summary) t LEFT JOIN intervals i ON t.hashtag = i.hashtag"""

_TAG = _quote(SERVING_HASHTAG)

ORACLE_SQL: dict[str, str] = {
    "ingest_normalize": _with("SELECT id, text, created FROM posts", "posts"),
    "publish_payload": _with("SELECT key, value FROM payload", "payload"),
    "parse_raw_json": _with("""
        SELECT id, text, created FROM (
          SELECT json_extract_string(value, '$.id') AS id, json_extract_string(value, '$.text') AS text,
                 json_extract_string(value, '$.created') AS created FROM payload)
        WHERE text IS NOT NULL AND id IS NOT NULL""", "payload"),
    "tail_texts": _with("SELECT json_extract_string(value, '$.text') AS text FROM payload", "payload"),
    "stream_tail": _with("SELECT json_extract_string(value, '$.text') AS text FROM payload", "payload"),
    "hashtag_extract": _with("SELECT id, hashtag FROM tagged", "tagged"),
    "hashtag_summary": _with("SELECT _id, hashtag, time FROM summary", "summary"),
    "raw_archive": _with(f"""
        SELECT value FROM payload
        WHERE regexp_matches(json_extract_string(value, '$.text'), '{_FIRST_TAG}')""", "payload"),
    "stream_speed_layer": _with("SELECT _id, hashtag, time FROM summary", "summary"),
    "stream_archive": _with(f"""
        SELECT value FROM payload
        WHERE regexp_matches(json_extract_string(value, '$.text'), '{_FIRST_TAG}')""", "payload"),
    "english_filter": _with("SELECT id, text FROM archive WHERE lang = 'en'", "archive"),
    "clean_text": _with("SELECT id, text FROM cleaned_ok", "cleaned_ok"),
    "remove_stop_words": _with("SELECT id, text FROM stemmed", "stemmed"),
    "tokenize": _with(f"""
        SELECT id, CAST(len({_TOKENS}) AS BIGINT) AS n_tokens,
               array_to_string({_TOKENS}, ' ') AS tokens_text
        FROM stemmed""", "stemmed"),
    "polarity_scores": _with("""
        SELECT id, text, n_tokens, pos_hits, neg_hits, pos_score, neg_score FROM scored""", "scored"),
    "score_join": _with("""
        SELECT id, text, n_tokens, pos_hits, neg_hits, pos_score, neg_score FROM scored""", "scored"),
    "polarity_scores_lexicon_join": _with("""
        SELECT id, text, n_tokens, pos_hits, neg_hits, pos_score, neg_score FROM scored""", "scored"),
    "sentiment_label": _with("SELECT _id, text, sentiment FROM sentiment", "sentiment"),
    "scored_tweets": _with("""
        SELECT id, text, pos_score, neg_score,
               CASE WHEN pos_score > neg_score THEN 'positive'
                    WHEN pos_score < neg_score THEN 'negative' ELSE 'neutral' END AS type
        FROM scored""", "scored"),
    "parse_event_time": _with("SELECT _id, time, timestamp FROM timed", "timed"),
    "parse_event_time_sql": _with("SELECT _id, time, timestamp FROM timed", "timed"),
    "summary_by_time": _with("SELECT _id, hashtag, timestamp FROM timed ORDER BY timestamp, _id", "timed"),
    "hashtag_lookup": _with(f"SELECT _id, hashtag, timestamp FROM timed WHERE hashtag = {_TAG}", "timed"),
    "hashtag_count": _with(f"SELECT count(*) AS n_rows FROM timed WHERE hashtag = {_TAG}", "timed"),
    "hashtag_preview": _with(f"""
        SELECT _id, hashtag, timestamp FROM timed WHERE hashtag = {_TAG}
        ORDER BY timestamp, _id LIMIT {PREVIEW_ROWS}""", "timed"),
    "summary_sentiment_join": _with("SELECT _id, hashtag, timestamp, sentiment FROM joined", "joined"),
    "positive_intervals": _with(f"""
        SELECT hashtag, start_ts, end_ts, seconds, tweets FROM intervals WHERE hashtag = {_TAG}""", "intervals"),
    "positive_intervals_all": _with("SELECT hashtag, start_ts, end_ts, seconds, tweets FROM intervals",
                                    "intervals"),
    "interval_report": _with(_REPORT, "summary", "intervals"),
    "intervals_sql": _with(f"""
        SELECT hashtag, start_ts, end_ts, seconds, tweets FROM intervals WHERE hashtag = {_TAG}""", "intervals"),
    "intervals_incremental": _with("SELECT hashtag, start_ts, end_ts, seconds, tweets FROM intervals", "intervals"),
    "intervals_bucketed": _with("SELECT hashtag, start_ts, end_ts, seconds, tweets FROM intervals", "intervals"),
    "stream_sentiment_join": _with("SELECT _id, hashtag, timestamp, sentiment FROM joined", "joined"),
    "lexicon_bitset": _with("""
        SELECT id, text, n_tokens, pos_hits, neg_hits, pos_score, neg_score FROM scored""", "scored"),
    "summary_upsert": _with("""
        SELECT _id, arg_max(hashtag, batch) AS hashtag, arg_max(time, batch) AS time FROM upserts GROUP BY _id""", "upserts"),
    "batch_incremental": _with("SELECT _id, text, sentiment FROM sentiment", "sentiment"),
    "stream_rejected": _with("SELECT key, value, reason FROM damaged", "damaged"),
    "archive_day": _with("SELECT value, date FROM dated WHERE date = (SELECT min(date) FROM dated)", "dated"),
    "language_profiles": _with("SELECT lang, gram, n FROM profiles", "profiles"),
    "detect_language": _with("SELECT id, lang FROM detected", "detected"),
    "sentiment_label_detected": _with("SELECT _id, text, sentiment FROM sentiment_d", "sentiment_d"),
    "stream_english": _with("SELECT id, text FROM english_d", "english_d"),
}
