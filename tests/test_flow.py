"""The flow of the README: from text files to predictions."""

import pytest
from pyspark.sql import functions as F

from starrung import EffectLadder, LadderModel
from starrung.functions import rmse
from starrung.operators.split import quartile_stratum, split_and_repair
from starrung.sources import read_items, read_ratings

TITLES = ["One (1990)", "Two: Again (1995)", "Three (2000)", "Four", "Five: V (1990)", "Six (2003)", "Seven (1995)"]
GENRES = ["Comedy", "Comedy|War", "Drama", "Sci-Fi|War", "(no genres listed)", "Drama|Romance|IMAX", "Film-Noir"]


def test_text_files_to_predictions(spark, ws, tmp_path):
    (tmp_path / "items.dat").write_text(
        "".join(f"{i}::{t}::{g}\n" for i, (t, g) in enumerate(zip(TITLES, GENRES), start=1))
    )
    lines = []
    for user in range(60):
        for item in range(1, 9):  # item 8 is not listed
            if (user * item) % 5 != 1:
                rating = min(10, max(1, user % 4 + item)) / 2
                lines.append(f"{user}::{item}::{rating}::{800000000 + user * 10000000}\n")
    (tmp_path / "ratings.dat").write_text("".join(lines))

    ratings = ws.table(read_ratings(spark, str(tmp_path / "ratings.dat")), "ratings")
    items = read_items(spark, str(tmp_path / "items.dat"))
    split = split_and_repair(ws, ratings, quartile_stratum(ws, ratings, "rating"), 0.1,
                             ["user_id", "item_id", "ts"], 1, ["item_id", "user_id"], True)
    ladder = EffectLadder(as_of_year=2020, bins=4)
    features = ladder.features(ws, items)
    assert features.rows == 7
    model = ladder.fit(ws, split.train, features)
    errors = {r.model: r.rmse for r in model.evaluate(ws, split.holdout, features).collect()}
    assert errors["3"] < errors["2"] < errors["1"]
    model.save(str(tmp_path / "model"))
    scored = LadderModel.load(spark, str(tmp_path / "model")).transform(ws, split.holdout, items)
    got = scored.agg(rmse(F.col("rating"), F.col("prediction")), F.count(F.lit(1))).first()
    assert got[0] == pytest.approx(errors["8"], abs=1e-9)
    assert got[1] == split.holdout.count() > 30
