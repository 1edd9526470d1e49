"""Names of persons, by a sequence tagger over runs of capitalised words, in built-in expressions.

A run is two to six capitalised words in a row, titles and initials included. The tagger gives each
word a state, name or other: a word's score is the sum of the weights of its features, changes of
state have weights too, and the best sequence of states (Viterbi) says how many names the run
has. The weights are those that ``train`` learns, an averaged structured perceptron over the labelled
runs of ``labelled_runs``; a test trains them anew. A lone name without a title is not looked for.
"""

from collections.abc import Callable
from functools import reduce
from itertools import product
from random import Random

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# A boundary, the small word before the run, and the run. No look-around: any engine can run it.
RUN = (
    r"(?:^|[^\p{L}\p{N}])(?:(\p{Ll}{1,20}),? )?"
    r"([A-Z][\p{L}'-]{0,30}\.?(?: [A-Z][\p{L}'-]{0,30}\.?){1,5})"
)

# Word lists and endings that the features look at.
GIVEN = (
    "alice amy andrew anna anne anthony barbara ben carl carlos carol charles chris clara daniel david diana edward "
    "elena elizabeth emily emma eric fatima frank george grace hannah helen henry ivan jack james jane john jorge "
    "joseph julia karen kevin laura linda lisa lucas maria mark mary michael miguel mohammed nancy olga olivia omar "
    "oscar patricia paul peter rachel richard robert rosa ruth sarah simon sofia sophie stephen susan thomas victor william"
).split()
TITLES = "mr mrs ms miss dr prof professor sir lady lord captain judge senator president".split()
CUES = "by with from contact dear named called hello hi thanks ask met sincerely regards signed author manager".split()
STOPS = (
    "the a an and of in on for to license version street road avenue city university college school company inc ltd "
    "corp bank park river lake mountain house hotel church museum north south east west new united states january "
    "february march april may june july august september october november december monday tuesday wednesday thursday "
    "friday saturday sunday public general blue red green bolt widget day week please see this that you we it"
).split()
ENDING = r"(?:son|sen|ez|ski|sky|ov|ova|ini|elli|mann|berg|stein|wood|ford|ley|field|worth|well)$"

# What a word, the words around it and its run tell: each a test of (word, before, after, place, words of the run).
FEATURES: dict[str, Callable[..., Column]] = {
    "any": lambda w, b, a, i, n: F.lit(True),
    "given": lambda w, b, a, i, n: _plain(w).isin(GIVEN),
    "title": lambda w, b, a, i, n: _plain(w).isin(TITLES),
    "initial": lambda w, b, a, i, n: w.rlike(r"^[A-Z]\.$"),
    "ending": lambda w, b, a, i, n: w.rlike(ENDING),
    "stop": lambda w, b, a, i, n: _plain(w).isin(STOPS),
    "capitals": lambda w, b, a, i, n: w.rlike("^[A-Z]{2,}$"),
    "after_title": lambda w, b, a, i, n: _plain(b).isin(TITLES),
    "after_given": lambda w, b, a, i, n: _plain(b).isin(GIVEN),
    "before_stop": lambda w, b, a, i, n: _plain(a).isin(STOPS),
    "cue": lambda w, b, a, i, n: (i == 0) & b.isin(CUES),
    "start": lambda w, b, a, i, n: (i == 0) & (b == ""),
    "same": lambda w, b, a, i, n: (w == b) | (w == a),
    "long": lambda w, b, a, i, n: n >= 4,
}
CHANGES = ("other_name", "name_name", "name_other", "name_end")

# Learned by ``train``; of a name's state, in the order of FEATURES and CHANGES.
WEIGHTS = {
    "any": -245, "given": 781, "title": -1023, "initial": 1428, "ending": 923, "stop": -1076, "capitals": 0,
    "after_title": 1239, "after_given": 757, "before_stop": -406, "cue": 490, "start": 83, "same": -370, "long": -14,
    "other_name": -484, "name_name": 239, "name_other": -677, "name_end": 193,
}


def _plain(word: Column) -> Column:
    return F.lower(F.rtrim(word, F.lit(".")))


def _each_word(run: Column, before: Column, tell: Callable[[list[Column]], Column]) -> Column:
    """What ``tell`` makes of the features of each word of a run."""
    words = F.split(run, " ")

    def of(word: Column, place: Column) -> Column:
        former = F.when(place == 0, before).otherwise(F.coalesce(F.get(words, place - 1), F.lit("")))
        following = F.coalesce(F.get(words, place + 1), F.lit(""))
        return tell([test(word, former, following, place, F.size(words)) for test in FEATURES.values()])

    return F.transform(words, of)


def _scores(run: Column, before: Column, weights: dict[str, int]) -> Column:
    def total(features: list[Column]) -> Column:
        parts = [F.when(held, weights[name]).otherwise(0) for name, held in zip(FEATURES, features)]
        return reduce(Column.__add__, parts)

    return _each_word(run, before, total)


def names_in_run(run: Column, before: Column, weights: dict[str, int] | None = None) -> Column:
    """How many names the best sequence of states has: each state keeps its best score and its names so far."""
    weights = weights or WEIGHTS
    start = F.struct(
        F.lit(0).alias("other"), F.lit(0).alias("others"), F.lit(-1_000_000).alias("name"), F.lit(0).alias("names")
    )

    def step(state: Column, score: Column) -> Column:
        began, went_on = state["other"] + weights["other_name"], state["name"] + weights["name_name"]
        ended = state["name"] + weights["name_other"]
        return F.struct(
            F.greatest(state["other"], ended).alias("other"),
            F.when(ended > state["other"], state["names"]).otherwise(state["others"]).alias("others"),
            (F.greatest(began, went_on) + score).alias("name"),
            F.when(went_on > began, state["names"]).otherwise(state["others"] + 1).alias("names"),
        )

    def end(state: Column) -> Column:
        return F.when(state["name"] + weights["name_end"] > state["other"], state["names"]).otherwise(state["others"])

    return F.aggregate(_scores(run, before, weights), start, step, end)


def person_hits(text: Column) -> Column:
    """Names of persons in whole texts; a null text has none."""
    runs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(RUN), F.lit(1)).alias("before"),
        F.regexp_extract_all(text, F.lit(RUN), F.lit(2)).alias("run"),
    )
    counts = F.transform(runs, lambda r: names_in_run(r["run"], r["before"]))
    total = F.aggregate(counts, F.lit(0), lambda a, n: a + n)
    return F.when(text.rlike(r"[A-Z][\p{L}'-]*\.? [A-Z]"), total).otherwise(0)


# Training -------------------------------------------------------------------

_SURNAMES = (
    "Smith Jones Miller Davis Garcia Lopez Wilson Anderson Taylor Moore Jackson Martin Lee Petrov Ivanova Rossini "
    "Hoffmann Goldberg Sandford Bradley Whitfield Nowak Kim Chen Okafor Silva Haddad Novak Byrne Costa"
).split()
_FIRST = "Zoe Liam Nadia Kenji Priya Tomas Ingrid Leila Pavel Yusuf".split()
_THINGS = (
    "Apache License;General Public License;Blue Bolt;Red Widget;New York;United States;Oxford Street;Grand Hotel;"
    "First National Bank;Monday Morning;The Green House;Lake Placid;Great Northern Railway;Data Privacy Policy;Terms Of Use;"
    "North Sea;High Street;Open Source Software;Gift Card;Summer Sale;Free Shipping;Central Park;Silver Spoon;"
    "And And And And;Of Of Of;Orre Orre;Stteen Erachtz;Thsterhe Onor;Machine Learning;World Cup;Order Status"
).split(";")


def labelled_runs(seed: int = 17, size: int = 4000) -> list[tuple[str, str, list[bool]]]:
    """Runs with the small word before them and, for each word, whether it is of a name."""
    draw, rows = Random(seed), []
    given = [name.title() for name in GIVEN]
    for _ in range(size):
        kind = draw.random()
        if kind < 0.5:
            first = draw.choice(given if draw.random() < 0.8 else _FIRST)
            words = [first] + ([f"{draw.choice('ABCDEFGHJKLMPRST')}."] if draw.random() < 0.2 else [])
            words, labels = words + [draw.choice(_SURNAMES)], None
            if draw.random() < 0.25:
                title = draw.choice(["Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Judge", "Dr"])
                words = [title, words[-1]] if draw.random() < 0.5 else [title, *words]
                labels = [False] + [True] * (len(words) - 1)
            labels = labels or [True] * len(words)
            if draw.random() < 0.1:
                words, labels = [draw.choice(["The", "See", "And", "Please"]), *words], [False, *labels]
        else:
            words = draw.choice(_THINGS).split()
            labels = [False] * len(words)
            if draw.random() < 0.15:
                words, labels = [*words, draw.choice(["Inc", "Street", "Version", "Day"])], [*labels, False]
        before = draw.choice(["", "", "the", "of", "in", "was", *(CUES if labels[-1] else ["our", "a", "from", "by"])])
        rows.append((before, " ".join(words[:6]), labels[:6]))
    return rows


def train(spark: SparkSession, rows: list[tuple[str, str, list[bool]]], rounds: int = 5) -> dict[str, int]:
    """Averaged structured perceptron: weights move to the labelled sequence from the best one wherever they differ."""
    frame = spark.createDataFrame(rows, "before string, run string, labels array<boolean>").coalesce(1)
    features = _each_word(F.col("run"), F.col("before"), lambda held: F.array(*held))
    found = frame.select(features.alias("features"), "labels").collect()
    weights, total, seen = dict.fromkeys([*FEATURES, *CHANGES], 0), dict.fromkeys([*FEATURES, *CHANGES], 0), 0
    for _ in range(rounds):
        for row in found:
            active = [[f for f, on in zip(FEATURES, word) if on] for word in row["features"]]
            best = max(product([False, True], repeat=len(active)), key=lambda states: _value(states, active, weights))
            for states, change in ((tuple(row["labels"]), 1), (best, -1)):
                for name in _parts(states, active):
                    weights[name] += change
            seen += 1
            for name, weight in weights.items():
                total[name] += weight
    return {name: round(100 * value / seen) for name, value in total.items()}


def _parts(states, active):
    former = False
    for state, names in zip(states, active):
        if state:
            yield from names
            yield "name_name" if former else "other_name"
        elif former:
            yield "name_other"
        former = state
    if former:
        yield "name_end"


def _value(states, active, weights):
    return sum(weights[name] for name in _parts(states, active))
