"""Queries on texts: terms, topics, language, sentiment, clean-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions import language
from supportlens.functions import text as tx
from supportlens.functions.sentiment import sentiment_bin
from supportlens.operators import enrich, polarity, reviews, rule_index, terms
from supportlens.plans.inputs import documents, load, question_versions, tweets, with_inputs
from supportlens.operators.forum import latest
from supportlens.sources import sinks

# The invented prose of the tables names no product, so rules and word lists are made of words it does use.
RULES = [
    ("article", "the"), ("article", "der"), ("article", "les"), ("article", "una"),
    ("pair", "the,of"), ("pair", "la,que"), ("pair", "und,ist"), ("phrase", "of the"), ("phrase", "de la"),
    ("opening", "_tion"), ("opening", "_sch,der"), ("closing", "ing_"), ("closing", "_en,ment_,la"), ("never", "_the,of,and"),
]
KEYWORDS = ["the", "of", "and", "la", "les", "que", "der", "und", "is", "una", "quick heal"]
UP, DOWN = ["the", "la", "der", "una", "is"], ["of", "les", "und", "que", "and"]
TURNS = ["on", "to", "et", "las", "das"]
BRANDS = ("the", "der")
PRODUCT = "Acme"


def _daily_terms(spark, sf):
    return terms.term_counts(tweets(spark, sf, spread=True), F.to_date("created_at"), "full_text", values.stop_terms(BRANDS))


def _top_terms(spark, sf):
    return terms.top_terms(_daily_terms(spark, sf), 100)


def _top_terms_merged(spark, sf):
    """From a stored table of daily counts and the stored summaries of its days."""
    daily, short = sinks.staging(spark, "daily-terms"), sinks.staging(spark, "term-summaries")
    _daily_terms(spark, sf).write.parquet(daily)
    counts = spark.read.parquet(daily)
    terms.term_summaries(counts).write.parquet(short)
    return terms.top_terms_merged(spark.read.parquet(short), counts, 100)


def _keywords(spark, sf):
    questions = latest(question_versions(spark, sf), "question_id")
    return terms.keyword_counts(questions, KEYWORDS)


def _topic_classify(spark, sf):
    docs = enrich.classify(documents(spark, sf), "text", RULES)
    return docs.select("doc_id", F.array_join("topics", "|").alias("topics"))


def _topic_classify_full(spark, sf):
    """The whole rule list; half of the documents get a sentence made of a rule's words."""
    rules = values.topic_rules(PRODUCT)
    said = F.array(*[F.lit(k.replace("_", "").replace(",", " ")) for _, k in rules])
    place = F.pmod(F.col("doc_id"), F.lit(2 * len(rules))).cast("int")
    text = F.concat_ws(" ", "text", F.get(said, place))
    docs = enrich.classify(documents(spark, sf).select("doc_id", text.alias("text")), "text", rules)
    return docs.select("doc_id", F.array_join("topics", "|").alias("topics"))


# Rules made of a part: its number, colour and noun, alone, together, as a phrase, and as the beginning or end of a word.
PART_RULES = [
    "sku{p}", "sku{p},{noun}", "sku{p},{colour},{noun}", "_sku{p}", "x{p}_", "_sku{p},{noun}", "x{p}_,{colour}", "sku{p} {colour}",
    "{colour} {noun},sku{p}", "sku{p},no{p}", "_x{p},_sku{p}", "{noun} sku{p}",
]


def _part_rules(spark, sf):
    words = F.split("p_name", " ")
    parts = load(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("p"), words[0].alias("colour"), words[1].alias("noun"), F.concat_ws("-", "p_type", "p_brand").alias("kind")
    )
    def made(rule):
        for name in ("p", "colour", "noun"):
            rule = F.replace(rule, F.lit("{" + name + "}"), F.col(name))
        return rule
    rules = F.transform(F.array(*map(F.lit, PART_RULES)), made)
    return parts.select(F.posexplode(rules).alias("n", "keywords"), "kind").select(F.concat_ws("-", "kind", "n").alias("topic"), "keywords")


def _topic_index(spark, sf):
    """At least as many as ten rules a part, as rows; each document names a few parts after its text."""
    n = F.col("doc_id")
    said = F.concat_ws(" ", F.concat(F.lit("SKU"), n), F.concat(F.lit("sku"), n % 500, F.lit("7 re-x"), n % 300), F.concat(F.lit("yx"), n % 90), F.element_at(F.split("text", " "), 1), F.lit("red bolt"))
    read = load(spark, sf, "documents")
    if read.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        read = documents(spark, sf)  # dealt out anew; files of many row groups need no such copy of the texts
    docs = read.select("doc_id", F.concat_ws(" ", "text", said).alias("text"))
    index = sinks.staged(rule_index.index_rules(_part_rules(spark, sf)), "rule-index")
    found = rule_index.classify(docs, "text", index, "doc_id")
    return found.select("doc_id", F.size("topics").alias("n"), F.array_join("topics", "|").alias("topics"))


def _topic_counts(spark, sf):
    docs = enrich.classify(documents(spark, sf), "text", RULES)
    found = docs.select("source", F.explode("topics").alias("topic"))
    return found.groupBy("source", "topic").agg(F.count("*").alias("n"))


def _sentiment_bins(spark, sf):
    score = F.col("l_discount") * 20 - 1
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", sentiment_bin(score, F.col("l_quantity") / 10).alias("sentiment")
    )


def _language(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return enrich.detect_language(docs, "text").drop("text")


def _language_filter(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return enrich.filter_language(enrich.detect_language(docs, "text")).drop("text")


def _language_letters(spark, sf):
    """Weights of two thirds of the documents by the checksum of their id, all documents scored by them: whole and by 30 characters."""
    docs = documents(spark, sf).select("doc_id", "text", "lang", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"))
    weights = language.language_weights(language.language_table(docs.where("not held_out"), "text", "lang"))
    whole = language.language_by_letters(docs, "text", weights)
    both = language.language_by_letters(whole.withColumn("start", F.substring("text", 1, 30)).withColumnsRenamed({"language": "whole", "confidence": "sure"}), "start", weights)
    return both.select("doc_id", "held_out", "lang", F.col("whole").alias("language"), F.round("sure", 6).alias("confidence"), F.col("language").alias("start_language"))


def _lexicon(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return enrich.score_sentiment(docs, "text", UP, DOWN).drop("text")


def _polar_words(spark, sf):
    return polarity.polar_words(documents(spark, sf), "text", UP, DOWN)


def _sentence_sentiment(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    polar = sinks.staged(_polar_words(spark, sf), "polar-words")
    return polarity.score_sentences(docs, "text", polar, "doc_id", TURNS).drop("text")


def _sentiment_step(df, text):
    return enrich.score_sentiment(df, text, UP, DOWN)


def _enrich_tweets(spark, sf):
    rich = enrich.enrich_tweets(tweets(spark, sf, spread=True), RULES, sentiment=_sentiment_step)
    return rich.drop("full_text").withColumn("topics", F.array_join("topics.topic", "|"))


def _enrich_questions(spark, sf):
    questions = latest(question_versions(spark, sf), "question_id")
    return enrich.enrich_questions(questions, sentiment=_sentiment_step).drop("metadata_array", "title")


def _strip(spark, sf):
    return load(spark, sf, "pages", spread_by="page_id").select("page_id", tx.strip_tags("html").alias("content"))


def _cap(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        tx.cap_text("text", values.LANGUAGE_TEXT_LIMIT).alias("language_text"),
        tx.cap_text("text", values.SENTIMENT_TEXT_LIMIT).alias("sentiment_text"),
    )


def _escape(spark, sf):
    text = F.replace("text", F.lit(". "), F.lit(".\r\n"))
    return documents(spark, sf).select(
        "doc_id",
        tx.escape_newlines(text).alias("line_feeds"),
        tx.escape_newlines(text, carriage_returns=True).alias("line_ends"),
    )


def _reviews(spark, sf):
    rows = documents(spark, sf).select(
        "doc_id",
        F.concat_ws("、", "source", "lang", "n_chars").alias("Review_Title"),
        F.concat("text", F.lit("、a，b")).alias("Review_Text"),
    )
    return reviews.clean_reviews(rows)


QUERIES = {
    "term_freq_daily": _daily_terms,
    "top_terms": _top_terms,
    "top_terms_merged": _top_terms_merged,
    "keyword_doc_freq": _keywords,
    "topic_classify": _topic_classify,
    "topic_classify_full": _topic_classify_full,
    "topic_index": _topic_index,
    "topic_counts": _topic_counts,
    "sentiment_bins": _sentiment_bins,
    "language_vote": _language,
    "language_filter": _language_filter,
    "language_letters": _language_letters,
    "lexicon_sentiment": _lexicon,
    "polar_words": _polar_words,
    "sentence_sentiment": _sentence_sentiment,
    "enrich_tweets": _enrich_tweets,
    "enrich_questions": _enrich_questions,
    "html_strip": _strip,
    "text_cap": _cap,
    "newline_escape": _escape,
    "review_clean": _reviews,
}


def quoted(items) -> str:
    return ", ".join("'" + str(i).replace("'", "''") + "'" for i in items)


# The oracle's regular expressions know only ASCII word signs, so they spell the classes out.
_W = r"\p{L}\p{N}_"


def _wide(pattern: str) -> str:
    """The pattern with its word class written out, inside brackets and outside."""
    return pattern.replace(r"[\w_]", f"[{_W}]").replace(r"[\w_", f"[{_W}").replace(r"[\w\'", f"[{_W}\\'").replace(r"\w", f"[{_W}]")


_TOKENS = ("(?i)(" + "|".join(_wide(p) for p in values.TOKEN_ALTERNATIVES) + ")").replace("'", "''")
_EMOTICON = ("(?i)^" + values.EMOTICON + "$").replace("'", "''")
_LOWER = f"CASE WHEN regexp_matches(token, '{_EMOTICON}') THEN token ELSE lower(token) END"

_TERMS = with_inputs("tweets", f"""
, terms AS (SELECT CAST(created_at AS DATE) AS tweet_dt, {_LOWER} AS tweet_word FROM (
  SELECT created_at, unnest(regexp_extract_all(full_text, '{_TOKENS}', 1)) AS token FROM tweets))
, counts AS (SELECT tweet_dt, tweet_word, count(*) AS tweet_freq FROM terms
  WHERE tweet_word NOT IN ({quoted(values.stop_terms(BRANDS))}) GROUP BY 1, 2)
""")


# A part of a rule in SQL: whole words between characters that are no word signs.
def _rule_sql(text: str, keywords: str) -> str:
    """Matches of a rule counted the way its groups tell them apart."""
    parts = [k.strip() for k in keywords.split(",")]
    open_parts = [p for p in parts if "_" in p]
    edge = rf"(?:^|[^{_W}])"

    def found(part: str) -> str:
        bare = part.replace("_", "").replace("-", "--").replace(".", f"(?:[{_W}]|[^{_W}]{{2}})").replace(" ", r"\s")
        if part.startswith("_"):
            bare = bare + f"[{_W}]+"
        elif part.endswith("_"):
            bare = f"[{_W}]+" + bare
        marked = rf"regexp_replace({text}, '([^{_W}])', '\1\1', 'g')"
        return f"regexp_extract_all({marked}, '(?i){edge}({bare.replace(chr(92) + 's', chr(92) + 's' + chr(92) + 's')})(?:[^{_W}]|$)', 1)"

    if not open_parts:
        alls = "list_concat(" + ", ".join(found(p) for p in parts) + ")" if len(parts) > 1 else found(parts[0])
        return f"len(list_distinct({alls})) >= {len(parts)}"
    opened = [f"len(list_distinct({found(p)}))" for p in open_parts]
    closed = [f"len({found(p)}) > 0" for p in parts if "_" not in p]
    blank = f" + CASE WHEN {' OR '.join(closed)} THEN 1 ELSE 0 END" if closed else ""
    return f"{' + '.join(opened)}{blank} >= {len(parts)}"


def _topics_sql(text: str, rules=tuple(RULES)) -> str:
    names = sorted({t for t, _ in rules})
    cases = []
    for name in names:
        test = " OR ".join(_rule_sql(text, k) for t, k in rules if t == name)
        cases.append(f"CASE WHEN {test} THEN '{name}' END")
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


def _words_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '\\p{{L}}+')"


def _count_sql(words: str, vocabulary) -> str:
    return f"len(list_filter({words}, lambda w: w IN ({quoted(vocabulary)})))"


def _language_sql(source: str, key: str, text: str) -> str:
    counts = ", ".join(f"{_count_sql('words', v)} AS n_{k}" for k, v in values.LANGUAGE_WORDS.items())
    names = [f"n_{k}" for k in values.LANGUAGE_WORDS]
    total, best = " + ".join(names), f"greatest({', '.join(names)})"
    cases = " ".join(f"WHEN n_{k} = {best} THEN '{k}'" for k in values.LANGUAGE_WORDS)
    return f"""SELECT {key}, CASE WHEN {total} = 0 THEN 'und' {cases} END AS language,
    CASE WHEN {total} = 0 THEN 0.0 ELSE {best} / ({total}) END AS confidence
  FROM (SELECT {key}, {counts} FROM (SELECT {key}, {_words_sql(text)} AS words FROM {source}))"""


_BIN = """CASE WHEN magnitude < 0.5 THEN 'neutral' WHEN score < -0.2 THEN 'negativ'
    WHEN score <= 0.2 THEN 'neutral' ELSE 'positive' END"""


def _lexicon_sql(source: str, key: str, text: str) -> str:
    return f"""SELECT {key}, score, magnitude, {_BIN} AS discrete_sentiment FROM (
    SELECT {key}, CASE WHEN up + down > 0 THEN (up - down) / (up + down) ELSE 0 END AS score,
      CAST(up + down AS DOUBLE) AS magnitude
    FROM (SELECT {key}, CAST({_count_sql('words', UP)} AS DOUBLE) AS up, CAST({_count_sql('words', DOWN)} AS DOUBLE) AS down
      FROM (SELECT {key}, {_words_sql(text)} AS words FROM {source})))"""


_SENTENCES = r"""
WITH said AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(text, '[^.!?\n]+'), lambda s: regexp_matches(s, '\p{L}'))) AS s,
    generate_subscripts(list_filter(regexp_extract_all(text, '[^.!?\n]+'), lambda s: regexp_matches(s, '\p{L}')), 1) AS place FROM documents),
spoken AS (SELECT doc_id, place, regexp_extract_all(lower(s), '\p{L}+') AS words FROM said),
"""
_POLAR = f"""flags AS (SELECT list_distinct(words) AS words, CAST(list_has_any(words, [{quoted(UP)}]) AS INT) AS up,
    CAST(list_has_any(words, [{quoted(DOWN)}]) AS INT) AS down FROM spoken),
totals AS (SELECT sum(up) AS all_up, sum(down) AS all_down FROM flags),
counted AS (SELECT word, sum(up) AS up, sum(down) AS down FROM (SELECT unnest(words) AS word, up, down FROM flags WHERE up + down > 0) GROUP BY 1),
rates AS (SELECT word, up, down, (up + 1) / (all_up + 1) AS a, (down + 1) / (all_down + 1) AS b FROM counted, totals),
polar AS (SELECT word, CAST(round(1000 * (a - b) / (a + b)) AS INT) AS polarity FROM rates
    WHERE up + down >= 5 AND word NOT IN ({quoted(UP + DOWN)}) AND abs(round(1000 * (a - b) / (a + b))) >= 200
  UNION ALL SELECT unnest([{quoted(UP)}]), 1000 UNION ALL SELECT unnest([{quoted(DOWN)}]), -1000)
"""
_Q = "title || ' ' || question_content"
_FULL = values.topic_rules(PRODUCT)

ORACLE = {
    "term_freq_daily": _TERMS + "SELECT * FROM counts",
    "top_terms": _TERMS + """SELECT tweet_word, CAST(sum(tweet_freq) AS BIGINT) AS tweet_freq FROM counts
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""",
    "top_terms_merged": _TERMS + """SELECT tweet_word, CAST(sum(tweet_freq) AS BIGINT) AS tweet_freq FROM counts
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""",
    "keyword_doc_freq": with_inputs("questions", f"""
SELECT CAST(created_date AS DATE) AS forum_dt, forum_word, count(*) AS forum_freq FROM (
  SELECT created_date, unnest(list_distinct(list_filter(list_transform(
      regexp_extract_all(question_content || ' ' || title, '{_TOKENS}', 1), lambda t: lower(t)),
      lambda t: t IN ({quoted(KEYWORDS)})))) AS forum_word FROM questions
  UNION ALL
  SELECT created_date, unnest(list_distinct(list_filter(list_transform(
      regexp_extract_all(metadata_array, '{_TOKENS}', 1), lambda t: lower(t)),
      lambda t: t IN ('os x', 'linux')))) FROM questions)
GROUP BY 1, 2"""),
    "topic_classify_full": f"""SELECT doc_id, array_to_string({_topics_sql('text', _FULL)}, '|') AS topics FROM (
  SELECT doc_id, concat_ws(' ', text, [{quoted([k.replace('_', '').replace(',', ' ') for _, k in _FULL])}][1 + doc_id % {2 * len(_FULL)}])
    AS text FROM documents)""",
    "topic_classify": f"SELECT doc_id, array_to_string({_topics_sql('text')}, '|') AS topics FROM documents",
    "topic_index": rf"""
WITH rules AS (
  SELECT p_type || '-' || p_brand || '-' || n AS topic, list_transform(string_split(replace(replace(replace(
      [{quoted(PART_RULES)}][n + 1], '{{p}}', CAST(p_partkey AS VARCHAR)), '{{colour}}', split_part(p_name, ' ', 1)),
      '{{noun}}', split_part(p_name, ' ', 2)), ','), lambda k: trim(k)) AS parts
  FROM part, range({len(PART_RULES)}) t(n)),
parts AS (SELECT DISTINCT topic, parts, unnest(parts) AS part FROM rules),
docs AS (SELECT doc_id, text || ' ' || concat_ws(' ', 'SKU' || doc_id, 'sku' || doc_id % 500 || '7 re-x' || doc_id % 300,
    'yx' || doc_id % 90, split_part(text, ' ', 1), 'red bolt') AS text FROM documents),
runs AS (SELECT doc_id, regexp_extract_all(text, '[{_W}]+') AS words, regexp_extract_all(text, '[^{_W}]+') AS gaps,
    CASE WHEN regexp_matches(text, '^[{_W}]') THEN 0 ELSE 1 END AS lead FROM docs),
placed AS (SELECT doc_id, words[i] AS word, CASE WHEN length(gaps[i + lead]) = 1 AND regexp_matches(gaps[i + lead], '[ \t\r\n]') THEN words[i] || gaps[i + lead] || words[i + 1] END AS pair
  FROM runs, range(1, len(words) + 1) t(i)),
shapes AS (SELECT DISTINCT doc_id, word, lower(word) AS w, 0 AS paired FROM placed
  UNION ALL SELECT DISTINCT doc_id, pair, regexp_replace(lower(pair), '[ \t\r\n]', ' '), 1 FROM placed WHERE pair IS NOT NULL),
met AS (
  SELECT s.doc_id, r.topic, r.parts, s.word, 0 AS opened FROM shapes s JOIN parts r ON r.part = s.w
  UNION SELECT s.doc_id, r.topic, r.parts, s.word, 1 FROM shapes s JOIN (SELECT * FROM parts WHERE part[1] = '_') r
    ON paired = 0 AND regexp_extract(s.w, '^(sku[0-9]|x[0-9])') = regexp_extract(r.part, '^_(sku[0-9]|x[0-9])', 1) AND s.w > replace(r.part, '_', '')
    AND starts_with(s.w, replace(r.part, '_', ''))
  UNION SELECT s.doc_id, r.topic, r.parts, s.word, 1 FROM (SELECT * FROM shapes WHERE regexp_matches(w, 'x[0-9]+$')) s
    JOIN (SELECT * FROM parts WHERE right(part, 1) = '_') r
    ON paired = 0 AND regexp_extract(s.w, 'x[0-9]+$') = replace(r.part, '_', '') AND length(s.w) > length(r.part) - 1),
counted AS (SELECT doc_id, topic, parts, count(*) FILTER (opened = 1) AS open, count(*) FILTER (opened = 0) AS closed FROM met GROUP BY ALL),
found AS (SELECT DISTINCT doc_id, topic FROM counted
  WHERE CASE WHEN len(list_filter(parts, lambda k: contains(k, '_'))) > 0 THEN open + CASE WHEN closed > 0 THEN 1 ELSE 0 END ELSE closed END >= len(parts))
SELECT doc_id, CAST(count(topic) AS INTEGER) AS n, coalesce(string_agg(topic, '|' ORDER BY topic), '') AS topics
FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id""",
    "topic_counts": f"""SELECT source, topic, count(*) AS n
FROM (SELECT source, unnest({_topics_sql('text')}) AS topic FROM documents) GROUP BY 1, 2""",
    "sentiment_bins": f"""SELECT l_orderkey, l_partkey, l_linenumber, {_BIN} AS sentiment
FROM (SELECT *, l_discount * 20 - 1 AS score, l_quantity / 10 AS magnitude FROM lineitem)""",
    "language_vote": _language_sql("documents", "doc_id", "text"),
    "language_filter": f"""SELECT doc_id FROM ({_language_sql('documents', 'doc_id', 'text')})
WHERE language = 'en' AND confidence >= 0.8""",
    "language_letters": rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS steps
  FROM range(256) t(i)),
docs AS (SELECT doc_id, text, lang, xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ord(d)),
    lambda a, b: xor(a >> 8, steps[1 + (xor(a, b) & 255)]), 4294967295)) % 3 = 1 AS held_out FROM documents, crc),
texts AS (SELECT doc_id, lang, held_out, 'whole' AS part, text FROM docs UNION ALL SELECT doc_id, lang, held_out, 'start', text[:30] FROM docs),
letters AS (SELECT doc_id, lang, held_out, part, list_transform(string_split(' ' || regexp_replace(lower(text), '[^\p{{L}}]+', ' ', 'g') || ' ', ''),
    lambda c: ord(c)) AS l FROM texts WHERE regexp_matches(text, '\p{{L}}')),
runs AS (SELECT doc_id, lang, held_out, part, ((l[i] * 31 + l[i + 1]) * 31 + l[i + 2]) % {language.BUCKETS} AS bucket
  FROM letters, range(1, len(l) - 1) t(i)),
counts AS (SELECT lang, bucket, count(*) AS n FROM runs WHERE NOT held_out AND part = 'whole' GROUP BY 1, 2),
totals AS (SELECT lang, sum(n) AS total FROM counts GROUP BY 1),
scored AS (SELECT r.doc_id, r.part, t.lang AS guess,
    CAST(sum(round(1000 * ln((coalesce(c.n, 0) + 1) / (t.total + {language.BUCKETS})))) AS DOUBLE) AS s
  FROM (SELECT doc_id, part, bucket FROM runs) r CROSS JOIN totals t LEFT JOIN counts c ON c.lang = t.lang AND c.bucket = r.bucket GROUP BY ALL),
ranked AS (SELECT *, max(s) OVER w AS best, row_number() OVER (PARTITION BY doc_id, part ORDER BY s DESC, guess) AS place FROM scored
  WINDOW w AS (PARTITION BY doc_id, part)),
said AS (SELECT doc_id, part, CASE WHEN max(s) - max(s) FILTER (place > 1) < 1000 * {language.MARGIN} THEN 'und' ELSE min(guess) FILTER (place = 1) END AS language,
    1 / sum(exp((s - best) / 1000)) AS confidence FROM ranked GROUP BY 1, 2)
SELECT doc_id, held_out, lang, coalesce(w.language, 'und') AS language, round(coalesce(w.confidence, 0), 6) AS confidence, coalesce(s.language, 'und') AS start_language
FROM docs LEFT JOIN (SELECT * FROM said WHERE part = 'whole') w USING (doc_id) LEFT JOIN (SELECT * FROM said WHERE part = 'start') s USING (doc_id)""",
    "lexicon_sentiment": _lexicon_sql("documents", "doc_id", "text"),
    "polar_words": _SENTENCES + _POLAR + "SELECT word, polarity FROM polar",
    "sentence_sentiment": _SENTENCES + _POLAR + f"""
, placed AS (SELECT doc_id, place, words[i] AS word, list_has_any(words[greatest(i - 3, 1) : i - 1], [{quoted(TURNS)}]) AND i > 1 AS negated
  FROM spoken, range(1, len(words) + 1) t(i)),
scored AS (SELECT doc_id, place, floor((2000 * sum(CASE WHEN negated THEN -polarity ELSE polarity END) + count(*)) / (2 * count(*))) AS s
  FROM placed JOIN polar USING (word) GROUP BY 1, 2),
texts AS (SELECT doc_id, floor((2 * sum(s) + count(*)) / (2 * count(*))) / 1e6 AS score, sum(abs(s)) / 1e6 AS magnitude FROM scored GROUP BY 1)
SELECT doc_id, score, magnitude, {_BIN} AS discrete_sentiment
FROM (SELECT doc_id, coalesce(score, 0) AS score, coalesce(magnitude, 0) AS magnitude FROM documents LEFT JOIN texts USING (doc_id))""",
    "enrich_tweets": with_inputs("tweets", f"""
, voted AS ({_language_sql('tweets', 'id_str', 'full_text')})
, scored AS ({_lexicon_sql('tweets', 'id_str', 'full_text')})
SELECT id_str, created_at, user_id, in_reply_to_status_id_str, score, magnitude, discrete_sentiment,
  array_to_string(list_concat([''], {_topics_sql('full_text')}), '|') AS topics
FROM tweets JOIN voted USING (id_str) JOIN scored USING (id_str) WHERE language = 'en' AND confidence >= 0.8"""),
    "enrich_questions": with_inputs("questions", f"""
, voted AS ({_language_sql('questions', 'question_id', _Q)})
, scored AS ({_lexicon_sql('questions', 'question_id', _Q)})
SELECT question_id, regexp_replace(question_content, '<[^<]+?>', '', 'g') AS question_content, created_date, updated,
  score, magnitude, discrete_sentiment
FROM questions JOIN voted USING (question_id) JOIN scored USING (question_id)
WHERE language = 'en' AND confidence > 0.8"""),
    "html_strip": "SELECT page_id, regexp_replace(html, '<[^<]+?>', '', 'g') AS content FROM pages",
    "text_cap": """SELECT doc_id, CASE WHEN strlen(text) > 2000 THEN substring(text, 1, 2000) ELSE text END AS language_text,
  CASE WHEN strlen(text) > 5000 THEN substring(text, 1, 5000) ELSE text END AS sentiment_text FROM documents""",
    "newline_escape": r"""SELECT doc_id, replace(text, chr(10), '\n') AS line_feeds,
  replace(replace(text, chr(10), '\n'), chr(13), '\n') AS line_ends
FROM (SELECT doc_id, replace(text, '. ', '.' || chr(13) || chr(10)) AS text FROM documents)""",
    "review_clean": """SELECT doc_id, source || ' ' || lang || ' ' || n_chars AS Review_Title,
  translate(text || '、a，b', ',、，', '   ') AS Review_Text FROM documents""",
}
