"""Table catalogue: the schema of every stored table, all columns nullable, timestamps in UTC."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "topics": T.ArrayType(T.StructType([T.StructField("topic", T.StringType())])),
}


def table(columns: str) -> T.StructType:
    """'a b: long, c: string' style text to a schema."""
    fields = []
    for group in columns.split(","):
        names, _, kind = group.rpartition(":")
        fields += [T.StructField(name, _TYPES[kind.strip()], True) for name in names.split()]
    return T.StructType(fields)


_QUESTION_HEAD = (
    "question_id: long, question_content: string, created_date: timestamp, creator_username: string, "
    "updated: timestamp, updated_by: string, is_solved: boolean, locale product title topic: string, "
)
_MENTION = "id_str: long, created_at: timestamp, full_text: string, user_id in_reply_to_status_id_str: long"
_SENTIMENT = "score magnitude: double, discrete_sentiment: string"

# Names, order and types of the stored columns.
TABLES: dict[str, T.StructType] = {
    "forum_questions_raw": table(
        _QUESTION_HEAD + "solution: long, solved_by: string, num_votes num_votes_past_week last_answer: long, "
        "metadata_array tags_array answers: string"
    ),
    "forum_answers_raw": table(
        "answer_id question_id: long, answer_content: string, created_date: timestamp, creator_username: string, "
        "updated: timestamp, updated_by: string, is_spam: boolean, num_helpful_votes num_unhelpful_votes: long"
    ),
    "forum_word_frequencies": table("forum_dt: date, forum_word: string, forum_freq: long"),
    "forum_sentiment_scores": table("question_id: long, " + _SENTIMENT + ", topic: string"),
    "forum_driving_sentiment": table("question_id: long, topic: string"),
    "forum_sentiment": table(
        _QUESTION_HEAD + "solved_by: string, num_votes num_votes_past_week: long, "
        "metadata_array tags_array answers: string, " + _SENTIMENT
    ),
    "twitter_mentions": table(_MENTION),
    "twitter_reviews": table(
        _MENTION + ", in_reply_to_status_text: string, in_reply_to_status_created_at: timestamp, "
        "in_reply_to_status_user_id: long"
    ),
    "twitter_word_frequencies": table("tweet_dt: date, tweet_word: string, tweet_freq: long"),
    "twitter_antivirus_frequencies": table("tweet_dt: date, tweet_word: string, tweet_freq: long"),
    "twitter_sentiment": table(_MENTION + ", " + _SENTIMENT + ", topics: topics"),
    "keywords_map": table("topic keywords: string"),
    "trend_queries": table(
        "update_date: date, region original_query translated_query query_key_ts: string, search_increase_pct: long"
    ),
    "trend_timeseries": table(
        "query_key: string, timestamp: timestamp, original_query: string, relative_search_volume: long"
    ),
    "survey_responses": table(
        "response_id: long, time_started date_submitted: timestamp, status: string, contact_id: long, "
        "language referer session_id user_agent: string, longitude latitude: double, "
        "country city state_region postal goal_accomplished rating: string"
    ),
    "release_calendar": table(
        "release product category: string, build_number: long, release_date: date, version description: string, "
        "is_security_driven: boolean, date_utc: date, day_num week_num: long"
    ),
    "store_reviews": table(
        "Package_Name: string, App_Version_Code: long, App_Version_Name Reviewer_Language Device: string, "
        "Review_Submit_Date_and_Time: timestamp, Review_Submit_Millis_Since_Epoch: long, "
        "Review_Last_Update_Date_and_Time: timestamp, Review_Last_Update_Millis_Since_Epoch Star_Rating: long, "
        "Review_Title Review_Text: string, Developer_Reply_Date_and_Time: timestamp, "
        "Developer_Reply_Millis_Since_Epoch: long, Developer_Reply_Text Review_Link: string"
    ),
    "ga_total_users": table("ga_date: date, ga_users: long"),
    "ga_total_users_kb": table("ga_date: date, ga_users: long"),
    "ga_total_users_kb_by_product": table("ga_date: date, ga_users: long, product: string"),
    "ga_users_by_country": table("ga_date: date, ga_country: string, ga_users: long"),
    "ga_inproduct_vs_organic": table("ga_date: date, ga_segment: string, ga_users ga_sessions: long"),
    "ga_inproduct_vs_organic_by_product": table(
        "ga_date: date, ga_segment: string, ga_users ga_sessions: long, product: string"
    ),
    "ga_inproduct_vs_organic_by_page": table(
        "ga_date: date, ga_page_path ga_segment: string, ga_pageviews ga_users ga_sessions: long, product: string"
    ),
    "ga_kb_exit_rate": table("ga_date: date, ga_exitPagePath: string, ga_exitRate: double, ga_exits ga_pageviews: long"),
    "ga_kb_exit_rate_by_product": table(
        "ga_date: date, ga_exitPagePath: string, ga_exitRate: double, ga_exits ga_pageviews: long, product: string"
    ),
    "ga_questions_exit_rate": table(
        "ga_date: date, ga_exitPagePath: string, ga_exitRate: double, ga_exits ga_pageviews: long"
    ),
    "ga_search_ctr": table("ga_date: date, ga_segment: string, ga_users ga_uniqueEvents: long"),
}

# Tables that grow with the data are stored by the day of their watermark column, in a further column `<column>_day`:
# scans by that column then list only the days they need, and a watermark reads only the last one.
STORED_BY_DAY = {
    "forum_questions_raw": "updated",
    "forum_answers_raw": "updated",
    "forum_sentiment": "created_date",
    "twitter_mentions": "created_at",
    "twitter_reviews": "created_at",
    "twitter_sentiment": "created_at",
    "survey_responses": "date_submitted",
    "twitter_word_frequencies": "tweet_dt",
    "forum_word_frequencies": "forum_dt",
    "trend_queries": "update_date",
    **{name: "ga_date" for name in TABLES if name.startswith("ga_")},
}

# Database tables and what each column is: int, bool, date and str as they say; text is str with line ends escaped;
# utc is a local time to move to UTC; int! must convert or the job fails.
MIRROR: dict[str, str] = {
    "kb_votes": "document_id: int!, title locale: str, created: utc, helpful: int!",
    "forums_forum": "id: int!, name slug description: str, last_post_id display_order is_listed: int!",
    "forums_post": "id thread_id: int, content: text, author_id: int, created updated: utc, updated_by_id: int",
    "forums_thread": (
        "id: int, title: str, forum_id: int, created: utc, creator_id last_post_id replies: int, "
        "is_locked is_sticky: bool"
    ),
    "kbforums_post": "id thread_id: int, content: text, creator_id: int, created updated: utc, updated_by_id: int",
    "kbforums_thread": (
        "id: int, title: str, document_id: int, created: utc, creator_id last_post_id replies: int, "
        "is_locked is_sticky: bool"
    ),
    "customercare_reply": (
        "id user_id: int, twitter_username: str, tweet_id: int, raw_json locale: str, created: utc, "
        "reply_to_tweet_id: int"
    ),
    "customercare_tweet": "tweet_id: int, raw_json locale: str, created: utc, reply_to_id: int, hidden: bool",
    "users_profile": "user_id: int, name timezone country city locale contributor_handle: str, involved_from: date",
    "wiki_document_products": "id document_id product_id: int",
    "wiki_document_topics": "id document_id topic_id: int",
    "wiki_locale": "id: int, locale: str",
    "wiki_document": (
        "id: int, title locale: str, current_revision_id latest_localizable_revision_id parent_id: int, html: text, "
        "category: int, slug: str, is_template is_localizable is_archived allow_discussion needs_change: bool, "
        "needs_change_comment share_link: str, display_order: int"
    ),
    "wiki_document_contributors": "id document_id user_id: int",
    "wiki_revision": (
        "id document_id: int, summary content: text, keywords: str, created reviewed: utc, significance: int, "
        "comment: str, reviewer_id creator_id: int, is_approved: bool, based_on_id: int, "
        "is_ready_for_localization: bool, readied_for_localization: utc, readied_for_localization_by_id: int, "
        "expires: utc"
    ),
    "products_product": (
        "id: int, title description: str, display_order: int, visible: bool, slug image: str, image_offset: int, "
        "image_cachebuster: str, sprite_height: int, image_alternate codename: str"
    ),
    "wiki_helpfulvote": (
        "id revision_id: int, helpful: bool, created: utc, creator_id: int, anonymous_id user_agent: str"
    ),
    "auth_user": (
        "id: int, username first_name last_name email: str, is_staff is_active is_superuser: bool, "
        "last_login date_joined: utc"
    ),
}

_MIRROR_TYPES = {
    "int": "long", "int!": "long", "str": "string", "text": "string", "bool": "boolean", "date": "date",
    "utc": "timestamp",
}


def mirror_kinds(spec: str) -> list[tuple[str, str]]:
    """(column, kind) pairs of a mirror spec, in order."""
    pairs = []
    for group in spec.split(","):
        names, _, kind = group.rpartition(":")
        pairs += [(name, kind.strip()) for name in names.split()]
    return pairs


def mirror_schema(spec: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[_MIRROR_TYPES[k]], True) for n, k in mirror_kinds(spec)])
