from marketlake.operators import routing


def test_messages(spark, rows):
    said = [
        "Search for EV companies", "search for EV companies", "please FIND banks", "find  banks ",
        "price of AAPL?", "what is the Price of TSLA now", "price for I", "price of GOOGLE", "the price is low",
        "hello", "find the price of AAPL", "price of NVDA",
    ]
    frame = spark.createDataFrame(list(enumerate(said)), "id int, message string")
    routed = routing.route_messages(frame)
    assert [tuple(r) for r in routed.orderBy("id").select("intent", "query", "ticker").collect()] == [
        ("search", "Search for EV companies", None), ("search", "EV companies", None),
        ("search", "please FIND banks", None), ("search", "banks", None),
        ("price", None, "AAPL?"), ("price", None, "TSLA"), ("price", None, "I"), ("help", None, None),
        ("help", None, None), ("help", None, None), ("search", "the price of AAPL", None), ("price", None, "NVDA"),
    ]
    quotes = spark.createDataFrame([("TSLA", 5.0)], "ticker string, price double")
    assert rows(routing.answer_prices(routed, quotes), "ticker", "price") == [
        ("AAPL?", None), ("I", None), ("NVDA", None), ("TSLA", 5.0),
    ]
    assert rows(routing.intent_counts(routed)) == [("help", 3), ("price", 4), ("search", 5)]
