"""Contracts of cards: what several rules ask of a card is found once for each row."""

from scholia.functions import patterns as V
from scholia.plans import contracts


def test_facts_of_a_card_are_found_once(spark, data):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = contracts.QUERIES["completed_card_issues"][0](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count(V.PACKET_SOURCE_HASH) == 1
    assert plan.count("$.reading.packet_sha256") <= 4  # its kind and its text
