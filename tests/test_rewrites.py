"""The plan rewrites (aggregate before the dimension join, pre-aggregated
outer joins, prefilters) equal the definitions, written as loops over the rows,
on random data with duplicate dimension keys and NULLs."""
import datetime as dt
from collections import Counter, defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from sparkmart.plans import analytics as A
from sparkmart.plans import models as M

SETTINGS = settings(max_examples=10, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
key = st.one_of(st.none(), st.integers(0, 4))
name = st.sampled_from(["a", "b", "c"])


def in_order(found):
    return sorted(found, key=lambda t: tuple((x is not None, x) for x in t))


@SETTINGS
@given(st.lists(st.tuples(key, key, st.one_of(st.none(), st.integers(0, 3))), max_size=40),
       st.lists(st.tuples(key, name), max_size=8),
       st.lists(st.tuples(key, st.integers(0, 2)), max_size=8),
       st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3)), max_size=4))
def test_top_competitors_counts_full_scores(spark, subs, hackers, challenges, difficulty):
    got = A.top_competitors(spark.createDataFrame(subs, "hacker_id int, challenge_id int, score int"),
                            spark.createDataFrame(hackers, "hacker_id int, name string"),
                            spark.createDataFrame(challenges, "challenge_id int, difficulty_level int"),
                            spark.createDataFrame(difficulty, "difficulty_level int, score int"))
    full = Counter()
    for who, what, points in subs:
        ways = sum(c == what and lev == level and points == best
                   for c, lev in challenges for level, best in difficulty) if None not in (who, what, points) else 0
        for person, called in hackers:
            if person == who:
                full[person, called] += ways
    assert rows(got) == in_order([k for k, n in full.items() if n > 1])


@SETTINGS
@given(st.lists(st.tuples(key, st.integers(0, 2), st.one_of(st.none(), st.integers(-5, 9))), max_size=40),
       st.lists(st.tuples(key, name), max_size=8))
def test_contest_leaderboard_sums_the_best(spark, subs, hackers):
    got = A.contest_leaderboard(spark.createDataFrame(subs, "hacker_id int, challenge_id int, score int"),
                                spark.createDataFrame(hackers, "hacker_id int, name string"))
    best = defaultdict(dict)
    for who, what, points in subs:
        if who is not None and points is not None:
            best[who][what] = max(points, best[who].get(what, points))
    want = {(h, n, sum(best[h].values())) for h, n in hackers if best.get(h)}
    assert rows(got) == in_order([w for w in want if w[2] > 0])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30), key, st.one_of(st.none(), st.integers(0, 90))), max_size=30),
       st.lists(st.tuples(key, name, st.one_of(st.none(), name)), max_size=8))
def test_int_customer_payment_totals(spark, payments, customers):
    p = spark.createDataFrame(
        [(pid, cid, 1, 1, None if a is None else Decimal(a), dt.datetime(2024, 1, 1)) for pid, cid, a in payments],
        "payment_id int, customer_id int, staff_id int, rental_id int, amount decimal(5,2), payment_date timestamp")
    c = spark.createDataFrame(customers, "customer_id int, first_name string, last_name string")
    want = []
    for customer, times in Counter(customers).items():   # equal customers share a group
        own = [a for _, cid, a in payments if cid == customer[0] and cid is not None]
        known = [a for a in own if a is not None]
        want.append((*customer, Decimal(sum(known) * times) if known else None, len(own) * times))
    assert rows(M.int_customer_payment(M.stg_payment(p), c)) == in_order(want)


@SETTINGS
@given(st.lists(st.tuples(name, st.one_of(st.none(), st.integers(-10, 110))), max_size=30),
       st.lists(st.tuples(st.integers(1, 10), st.integers(0, 100), st.integers(0, 30)), max_size=12))
def test_grade_report_finds_the_bands(spark, students, bands):
    g = [(grade, lo, lo + w) for grade, lo, w in bands]
    want = []
    for who, marks in students:
        hit = [grade for grade, lo, hi in g if marks is not None and lo <= marks <= hi]
        want += [(who if grade > 7 else None, grade, marks) for grade in hit] or [(None, None, marks)]
    got = A.grade_report(spark.createDataFrame(students, "name string, marks int"),
                         spark.createDataFrame(g, "grade int, min_mark int, max_mark int"))
    assert rows(got) == in_order(want)
