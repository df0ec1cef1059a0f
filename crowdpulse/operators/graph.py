"""What the relational tables say about a person: friends, colleagues, schoolmates, forums.

``clients`` are the people to be served: a short list from the configuration, a table with a
column ``person_id``, or ``None`` for everybody. A list becomes a filter on the tables (and reaches
the scan) and its rows are handed out to the tasks; a table is joined. Paths over a person or an
organisation that very many rows name are dealt to several tasks (``counted_paths``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.schema import Weights
from crowdpulse.session import handed_out, written

#: Paths of two steps over one person or organisation that a task is meant to form.
PATHS = 1_000_000


def listed(clients) -> bool:
    """Whether the served people are a short list, not a table or everybody."""
    return clients is not None and not isinstance(clients, DataFrame)


def served(df: DataFrame, column: str, clients) -> DataFrame:
    """The rows whose ``column`` is a served person."""
    if clients is None:
        return df
    if isinstance(clients, DataFrame):
        return df.join(clients.select(F.col("person_id").alias(column)).distinct(), column, "left_semi")
    return df.filter(F.col(column).isin(*clients))


def everybody(static: dict[str, DataFrame]) -> DataFrame:
    """``person_id`` of everyone whom one of the relational tables names."""
    knows = static["person_knows_person"]
    columns = [knows["person_id1"], knows["person_id2"]]
    people = knows.select(F.explode(F.array(*columns)).alias("person_id"))
    for name in ("person_workAt_organisation", "person_studyAt_organisation", "forum_has_member"):
        people = people.unionByName(static[name].select("person_id"))
    return people.filter("person_id is not null").distinct()


def friends(knows: DataFrame, clients) -> DataFrame:
    return served(knows, "person_id1", clients).select(
        F.col("person_id1").alias("person_id"), F.col("person_id2").alias("friend_id")
    )


def dealt_hubs(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``first`` (person_id, via) and ``second`` (via, candidate_id) with ``part``, to be joined on via and part.

    Where more than ``PATHS`` paths go over one ``via``, the rows of its longer side are dealt to as
    many parts as that takes and those of the shorter side are given to each part.
    """
    ends = first.groupBy("via").agg(F.count("*").alias("n1")).join(second.groupBy("via").agg(F.count("*").alias("n2")), "via")
    paths = F.col("n1").cast("double") * F.col("n2")
    # No more rows than there are paths over PATHS; its size is known once it is written.
    hubs = written(
        ends.filter(paths > PATHS).select("via", F.ceil(paths / PATHS).cast("int").alias("parts"), (F.col("n1") >= F.col("n2")).alias("deal_first"))
    )

    def dealt(side: DataFrame, is_first: bool, end: str) -> DataFrame:
        own = F.array(F.pmod(F.xxhash64(end), F.col("parts")).cast("int"))
        part = (
            F.when(F.col("parts").isNull(), F.array(F.lit(0)))
            .when(F.col("deal_first") == is_first, own)
            .otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
        )
        return side.join(hubs, "via", "left").select(*side.columns, F.explode(part).alias("part"))

    return dealt(first, True, "person_id"), dealt(second, False, "candidate_id")


def counted_paths(first: DataFrame, second: DataFrame) -> DataFrame:
    """``person_id, candidate_id, count`` of the paths from ``first`` (person_id, via) on over ``second`` (via, candidate_id).

    A path does not come back to its person. Each task adds up its own paths before they are exchanged.
    """
    one, other = dealt_hubs(first, second)
    return (
        one.join(other, ["via", "part"]).filter("person_id <> candidate_id")
        .groupBy("person_id", "candidate_id").agg(F.count("*").alias("count"))
    )


def in_degree(knows: DataFrame) -> DataFrame:
    """How often each person is named as somebody's friend."""
    return knows.groupBy(F.col("person_id2").alias("candidate_id")).agg(F.count("*").alias("count"))


def befriended_by(knows: DataFrame, clients) -> DataFrame:
    """For everybody a client counts as a friend: the sorted array of those clients.

    The array holds clients only, so its length is bounded by the configured list.
    """
    return friends(knows, clients).groupBy(F.col("friend_id").alias("candidate_id")).agg(
        F.sort_array(F.collect_set("person_id")).alias("excluded")
    )


def client_array(clients) -> Column:
    return F.array(*[F.lit(int(c)).cast("bigint") for c in clients])


def for_other_clients(df: DataFrame, clients) -> DataFrame:
    """One row per client that the row's ``excluded`` array does not name."""
    open_to = F.array_except(client_array(clients), F.coalesce("excluded", F.expr("array()").cast("array<bigint>")))
    return df.withColumn("person_id", F.explode(open_to)).drop("excluded")


def non_friends(knows: DataFrame, clients) -> DataFrame:
    """Everybody who is named as a friend by someone but not by the client, with the count.

    The client list is handed out to each row from the configuration; there is no join of
    all people with all clients.
    """
    if not listed(clients):
        raise ValueError("non_friends has a row for each pair of people; it is for a list of clients")
    known = in_degree(knows).join(befriended_by(knows, clients), "candidate_id", "left")
    return for_other_clients(known, clients).select("person_id", "candidate_id", "count")


def common_friends(knows: DataFrame, clients, ordered: bool = False) -> DataFrame:
    """Paths of two steps from the client, per end point; the client is on neither step.
    ``ordered`` puts the largest counts first."""
    second = knows.select(F.col("person_id1").alias("friend_id"), F.col("person_id2").alias("candidate_id"))
    if listed(clients):
        counts = (
            second.join(handed_out(friends(knows, clients)), "friend_id")
            .filter((F.col("friend_id") != F.col("person_id")) & (F.col("candidate_id") != F.col("person_id")))
            .groupBy("person_id", "candidate_id").agg(F.count("*").alias("count"))
        )
    else:
        first = friends(knows, clients).filter("person_id <> friend_id").withColumnRenamed("friend_id", "via")
        counts = counted_paths(first, second.withColumnRenamed("friend_id", "via"))
    return counts.orderBy("person_id", F.desc("count"), "candidate_id") if ordered else counts


def shared_organisations(members: DataFrame, clients) -> DataFrame:
    """Number of organisations each other person shares with the client (work or school)."""
    mine = served(members, "person_id", clients).select("person_id", "organisation_id")
    theirs = members.select(F.col("person_id").alias("candidate_id"), "organisation_id")
    if not listed(clients):
        return counted_paths(
            mine.withColumnRenamed("organisation_id", "via"), theirs.select(F.col("organisation_id").alias("via"), "candidate_id")
        )
    return (
        theirs.join(handed_out(mine), "organisation_id").filter("person_id <> candidate_id")
        .groupBy("person_id", "candidate_id").agg(F.count("*").alias("count"))
    )


def client_forums(forum_members: DataFrame, clients) -> DataFrame:
    return served(forum_members, "person_id", clients).select("person_id", "forum_id").distinct()


def forums_per_person(forum_members: DataFrame) -> DataFrame:
    """Distinct forums per person, largest first."""
    return (
        forum_members.select("person_id", "forum_id").distinct()
        .groupBy("person_id").agg(F.count("*").alias("c"))
        .orderBy(F.desc("c"), "person_id")
    )


def positive_static_scores(knows: DataFrame, work: DataFrame, study: DataFrame, clients,
                           weights: Weights = Weights()) -> DataFrame:
    """``person_id, candidate_id, score`` of all pairs the tables connect; friends stay out."""
    sources = [
        (common_friends(knows, clients), weights.common_friends),
        (shared_organisations(work, clients), weights.work),
        (shared_organisations(study, clients), weights.study),
    ]
    scored = [
        df.select("person_id", "candidate_id", (F.col("count") * F.lit(w)).alias("score"))
        for df, w in sources
    ]
    mine = friends(knows, clients).select("person_id", F.col("friend_id").alias("candidate_id"))
    return (
        scored[0].unionByName(scored[1]).unionByName(scored[2])
        .groupBy("person_id", "candidate_id").agg(F.sum("score").alias("score"))
        .join(mine, ["person_id", "candidate_id"], "left_anti")
    )


def static_scores(knows: DataFrame, work: DataFrame, study: DataFrame, clients,
                  weights: Weights = Weights()) -> DataFrame:
    """All candidates of each client: the connected ones, and every non-friend with 0. For a list of clients."""
    knows = written(knows.select("person_id1", "person_id2"))
    zero = non_friends(knows, clients).select(
        "person_id", "candidate_id", F.lit(0).cast("bigint").alias("score")
    )
    return (
        positive_static_scores(knows, work, study, clients, weights).unionByName(zero)
        .groupBy("person_id", "candidate_id").agg(F.sum("score").alias("score"))
    )
