"""Answering tables of chat messages by keyword."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ontarmac import constants as K
from ontarmac.functions import text
from ontarmac.operators.scoring import with_route_info


def with_intent(messages: DataFrame, column: str = "text") -> DataFrame:
    return messages.withColumn("tool_name", text.intent(column))


def with_named_route(messages: DataFrame, column: str = "text") -> DataFrame:
    """The first two three-letter words as origin and destination; fewer than two name no route."""
    codes = text.named_codes(column)
    found = F.size(codes) >= 2
    return messages.withColumns(
        {"origin": F.when(found, F.get(codes, 0)), "dest": F.when(found, F.get(codes, 1))}
    )


def answers(messages: DataFrame, column: str = "text") -> DataFrame:
    """One answer per message.

    A message may carry a scored flight: ``flight_origin``, ``flight_dest``, ``probability_delay_15``,
    ``summary`` and ``reasons``, all NULL where it has none. ``failed`` marks answers that say what is missing.
    """
    has_flight = F.col("probability_delay_15").isNotNull()
    named = with_named_route(with_intent(messages, column), column)
    routed = with_route_info(
        named.withColumns(
            {"origin": F.coalesce("flight_origin", "origin"), "dest": F.coalesce("flight_dest", "dest")}
        )
    )
    route_answer, route_ok = _route_answer()
    per_tool = {
        "get_route_info": (route_ok, route_answer),
        "explain_prediction": (
            has_flight,
            F.when(
                has_flight, F.concat_ws(" ", F.col("summary"), F.concat_ws(" ", F.col("reasons")))
            ).otherwise(K.TEXT_NEED_FLIGHT_TO_EXPLAIN),
        ),
        "predict_delay": (
            has_flight,
            F.when(has_flight, text.predict_sentence("probability_delay_15")).otherwise(
                K.TEXT_NEED_FLIGHT_TO_PREDICT
            ),
        ),
    }
    answer, ok = F, F
    for tool, (sound, words) in per_tool.items():
        answer = answer.when(F.col("tool_name") == tool, words)
        ok = ok.when(F.col("tool_name") == tool, sound)
    return routed.withColumns(
        {"assistant_message": answer.otherwise(K.TEXT_HELP), "failed": ~ok.otherwise(F.lit(True))}
    ).select(*messages.columns, "tool_name", "assistant_message", "failed")


def _route_answer() -> tuple[Column, Column]:
    unknown = "Unsupported airport code: "
    sentence = text.route_sentence(
        F.upper("origin"), F.upper("dest"), F.col("distance_miles"), F.col("origin_wac"), F.col("dest_wac")
    )
    answer = (
        F.when(F.col("origin").isNull() | F.col("dest").isNull(), K.TEXT_NEED_ROUTE)
        .when(F.col("origin_city").isNull(), F.concat(F.lit(unknown), "origin"))
        .when(F.col("dest_city").isNull(), F.concat(F.lit(unknown), "dest"))
        .when(F.upper("origin") == F.upper("dest"), "Origin and destination must be different.")
        .otherwise(sentence)
    )
    ok = F.col("origin_city").isNotNull() & F.col("dest_city").isNotNull() & (F.upper("origin") != F.upper("dest"))
    return answer, ok
