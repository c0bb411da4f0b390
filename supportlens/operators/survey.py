"""Survey responses: typed rows and answer counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.functions.cast import parse_double, parse_long
from supportlens.functions.time import survey_text_to_utc

# API field and table column, in table order.
FIELDS = {
    "status": "status",
    "contact_id": "contact_id",
    "language": "language",
    "referer": "referer",
    "session_id": "session_id",
    "user_agent": "user_agent",
    "longitude": "longitude",
    "latitude": "latitude",
    "country": "country",
    "city": "city",
    "region": "state_region",
    "postal": "postal",
}
QUESTIONS = {"2": "goal_accomplished", "4": "rating"}


def survey_rows(data: DataFrame, observed: bool = False) -> DataFrame:
    """API survey records to table rows. Rows without two readable times drop out, `unread_rows` has them; an unanswered
    question is ''."""
    typed = {"contact_id": parse_long, "longitude": parse_double, "latitude": parse_double}
    rows = data.select(
        parse_long(F.col("id")).alias("response_id"),
        survey_text_to_utc("date_started", observed).alias("time_started"),
        survey_text_to_utc("date_submitted", observed).alias("date_submitted"),
        *[(typed[f](F.col(f)) if f in typed else F.col(f)).alias(name) for f, name in FIELDS.items()],
        *[_answer(q).alias(name) for q, name in QUESTIONS.items()],
    )
    return rows.where("time_started is not null and date_submitted is not null")


def unread_rows(data: DataFrame, observed: bool = False) -> DataFrame:
    """The records that survey_rows leaves out, as they came, to be stored aside."""
    times = [survey_text_to_utc(name, observed) for name in ("date_started", "date_submitted")]
    return data.where(times[0].isNull() | times[1].isNull())


def export_rows(data: DataFrame) -> DataFrame:
    """The export's plain projection: the source's own texts, and '' for what was not answered."""
    return data.select(
        "id",
        "date_started",
        "date_submitted",
        *FIELDS,
        *[_answer(q).alias(name) for q, name in QUESTIONS.items()],
    )


def _answer(question: str) -> Column:
    return F.coalesce(F.try_element_at("survey_data", F.lit(question))["answer"], F.lit(""))


def answer_counts(responses: DataFrame, question: str, name: str) -> DataFrame:
    """Responses of each answer; the row for no answer counts 0."""
    return responses.groupBy(F.col(question).alias(name)).agg(F.count(question).alias("count"))
