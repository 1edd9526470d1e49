"""The tagger for names: its weights, planted names, and its best sequences against trying all."""

from itertools import product
from random import Random

from pyspark.sql import functions as F

from storeledger.functions import person

# Names that training has not seen, and what looks like one.
GIVEN = "Maria Peter Laura Hannah Victor Sofia Oscar Ruth Helen Omar".split()
SURNAMES = "Gonzalez Lindqvist Abernathy Kowalski Thompson Dubois Yamamoto Bianchi Eriksen Stone".split()
WITH_NAMES = [
    "please contact {} before noon", "the report was written by {}.", "Sincerely, {}", "{} said no.", "we met {} there",
    "ask {}, who knows", "Hello {}, welcome", "it was signed by {} in May",
]
WITHOUT = [
    "Released under the MIT License.", "the GNU General Public License applies", "buy a Blue Bolt or a Red Widget",
    "Stteen Erachtz und Orre Orre.", "we met on Monday Morning in New York", "from Oxford Street to Grand Hotel",
    "And Of The In", "the United States of something", "a Great Northern Railway train", "nothing at all", "",
    "Free Shipping on every order", "Terms Of Use and Privacy Policy", "Central Park and High Street",
]


def hits(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    return [r[0] or 0 for r in rows.orderBy("i").select(person.person_hits(F.col("text"))).collect()]


def test_weights_are_those_that_training_gives(spark):
    assert person.train(spark, person.labelled_runs()) == person.WEIGHTS


def test_planted_names(spark):
    draw, texts, planted = Random(5), [], []
    for _ in range(400):
        if draw.random() < 0.6:
            name = f"{draw.choice(GIVEN)} {draw.choice(SURNAMES)}"
            if draw.random() < 0.3:
                name = f"{draw.choice(['Dr.', 'Mrs.', 'Mr.'])} {draw.choice(['', name.split()[0] + ' '])}{name.split()[1]}"
            texts.append(f"so {draw.choice(WITH_NAMES)}".format(name) if draw.random() < 0.5 else draw.choice(WITH_NAMES).format(name))
            planted.append(1)
        else:
            texts.append(draw.choice(WITHOUT))
            planted.append(0)
    got = hits(spark, texts)
    true = sum(min(g, p) for g, p in zip(got, planted))
    precision, recall = true / sum(got), true / sum(planted)
    assert precision >= 0.95 and recall >= 0.9, (precision, recall)


def test_texts(spark):
    texts = [
        None, "", "Anna", "Anna Smith", "Anna Smith Anna Smith", "met Dr. Okafor and Mr. John Q. Wells", "anna smith",
        "x" * 5000 + " by Emily Carter " + "y " * 5000, "Éric Dubois", "by Paul Stone, by Mary Stone\nby Mark Stone",
    ]
    assert hits(spark, texts) == [0, 0, 0, 1, 1, 2, 0, 1, 0, 3]


def test_best_sequence(spark):
    """The expression's count is that of the best of all sequences of states."""
    runs = [(b, r, labels) for b, r, labels in person.labelled_runs(seed=3, size=150)]
    frame = spark.createDataFrame(runs, "before string, run string, labels array<boolean>").coalesce(1)
    features = person._each_word(F.col("run"), F.col("before"), lambda held: F.array(*held))
    count = person.names_in_run(F.col("run"), F.col("before"))
    for row in frame.select(features.alias("features"), count.alias("names")).collect():
        active = [[f for f, on in zip(person.FEATURES, word) if on] for word in row["features"]]
        values = {s: person._value(s, active, person.WEIGHTS) for s in product([False, True], repeat=len(active))}
        names = {sum(now and not was for was, now in zip((False, *s), s)) for s, v in values.items() if v == max(values.values())}
        assert row["names"] in names
