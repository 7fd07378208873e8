import random
from datetime import datetime

from linewright.plans import cards

SCHEMA = (
    "transaction_id string, customer_id string, merchant_id string, mcc_code string, timestamp timestamp, "
    "amount double, payment_method string, three_ds_result string, count_tx_30d int, avg_amount_30d double, "
    "age int, " + ", ".join(f"{f} int" for f in cards.FLAGS) + ", is_fraud int"
)


def transactions(spark):
    rng = random.Random(12)
    rows = []
    for i in range(600):
        when = datetime(rng.choice([2021, 2022, 2023, 2024]), 6, 1 + i % 28)
        amount = rng.expovariate(1 / 200)
        tor = int(rng.random() < 0.1)
        fraud = int(amount > 400 or (tor and rng.random() < 0.8))
        flags = [rng.choice([0, 1, None]), tor] + [rng.choice([0, 1, None]) for _ in range(5)]
        rows.append(
            (f"t{i}", f"c{i % 9}", f"m{i % 5}", "5411", when, amount, rng.choice(["online", "pos"]),
             rng.choice(["OK", "FAILED", None]), i % 7, rng.choice([None, 50.0]), rng.choice([None, 30, 40]),
             *flags, fraud)
        )
    return spark.createDataFrame(rows, SCHEMA)


def test_flow(spark):
    tagged = cards.split(transactions(spark))
    routed = cards.routes(tagged.schema)
    assert routed.categorical == ["payment_method", "three_ds_result"]
    assert routed.numeric == ["amount", "count_tx_30d", "avg_amount_30d", "age"]
    assert routed.boolean == list(cards.FLAGS)
    imputed = cards.preparation(tagged.schema)[0].getInputCols()
    assert imputed == ["amount", "avg_amount_30d", "age"]
    result = cards.compare_models(tagged).collect()
    assert {r.model for r in result} == {"logistic_regression", "random_forest", "gradient_boosting"}
    assert result[0].auc_pr >= result[-1].auc_pr > 0.5
