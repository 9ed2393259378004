from newsloom.llm import toxicity


def test_scorers_forget_and_score_alike():
    """A scorer holds a bounded number of words, however many a text has, and a forgotten word gets its score again."""
    scorer = toxicity.Model({"bad": 4.0}, 1.0, 1.0, 1.0, 0.0, 0.1).scorer()
    first = scorer["bad"]
    for i in range(120_000):
        assert scorer[f"w{i}"] == -toxicity.DRIFT
    assert len(scorer) <= 60_000
    assert scorer["bad"] == first == 4.0 - toxicity.DRIFT
