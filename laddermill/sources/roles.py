"""The generic star schema read as ranked matches: which columns play which role, in Spark and in DuckDB.

Each property is a lazy DataFrame; ROLE_CTES holds the same tables as SQL text for the twins.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Thresholds for small tables; the operators' own defaults are for a hundred million rows.
SMALL = {"min_n": 5, "min_winners": 10, "min_share": 0.05, "min_games": 5}
TRAINED = [83, 4, 7, 448, 751, 74, 93, 13, 39, 5]
RESEARCHED = [22, 213, 249, 202, 203, 14, 13, 55, 182, 278]


#: Lines that a task holds at most, and at least if there are enough tasks.
MOST_LINES, LEAST_LINES = 250_000, 50_000


#: Columns of matches and of players, over orders with their customer's nation and over lines with a civ.
MATCH_SQL = {
    "source": "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'replay' else 'archive' end",
    "ladder": "case when n_players = 2 then '1v1' else 'team' end",
    "map_id": "n_regionkey",
    "build": "year(o_orderdate)",
    "played_at": "o_orderdate",
    "duration_ms": "1800000",
    "n_players": "n_players",
}
PLAYER_SQL = {
    "match_id": "l_orderkey",
    "profile_id": "l_linenumber",
    "civ_id": "civ_id",
    "elo": "case when l_discount >= 0.095 then null else cast(800 + floor(l_extendedprice / 60) as int) end",
    "won": "case when l_returnflag = 'N' and l_linenumber = 7 then null else l_linestatus = 'F' end",
    "opening_kind": "case l_suppkey % 5 when 0 then 'scouts' when 1 then 'archers' when 2 then 'fast_castle' when 3 then 'drush' end",
    "feudal_t": "case when l_suppkey % 11 = 0 then null else 400 + l_quantity * 8 end",
    "castle_t": "case when l_suppkey % 7 = 0 or l_suppkey % 11 = 0 then null else 700 + l_quantity * 8 + l_partkey % 300 end",
    "imperial_t": "case when l_suppkey % 3 = 0 or l_suppkey % 7 = 0 or l_suppkey % 11 = 0 then null else 1300 + l_quantity * 8 + l_partkey % 300 end",
}


def named(columns: dict[str, str]) -> list[str]:
    return [f"{sql} {name}" for name, sql in columns.items()]


#: Roles that `keep` has written, by corpus and role: folders.
_KEPT: dict[tuple[str, str], str] = {}


def keep(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ("lines", "matches", "players", "events", "techs", "units", "sessions", "session_players")) -> None:
    """Writes the roles once to the shared folder; from then on the Tables of this corpus read them there."""
    from laddermill.sources.archives import scratch

    for name in names:
        path = scratch(spark, f"role-{name}")
        getattr(Tables(spark, sf_dir), name).write.parquet(path)
        _KEPT[sf_dir, name] = path


def role(make):
    """A lazy table, read from where `keep` has written it if it has."""

    def get(self) -> DataFrame:
        path = _KEPT.get((self.sf_dir, make.__name__))
        return self.spark.read.parquet(path) if path else make(self)

    get.__name__, get.__doc__ = make.__name__, make.__doc__
    return cached_property(get)


class Tables:
    """The tables of one corpus. `raw(x)` is the given table x; the other properties are roles."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def parts(self) -> int:
        """Among how many tasks lines and players are dealt, by their number, so that a task's part does not grow with them."""
        n = self.raw("lineitem").count()
        return max(-(-n // MOST_LINES), min(self.spark.sparkContext.defaultParallelism, -(-n // LEAST_LINES)), 1)

    def by_order(self, rows: DataFrame) -> DataFrame:
        """Lines dealt by their order, if there are more of them than the session's shuffles have tasks for."""
        return rows.repartition(self.parts, "l_orderkey") if self.parts > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else rows

    @staticmethod
    def first_lines(rows: DataFrame) -> DataFrame:
        order = W.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
        return rows.withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")

    @role
    def lines(self) -> DataFrame:
        """One line per order and number: the first by part, supplier, price and date."""
        return self.first_lines(self.by_order(self.raw("lineitem")))

    @cached_property
    def player_lines(self) -> DataFrame:
        """`lines` dealt by player among `parts` tasks, for what each becomes several rows of: left to the session's
        shuffles, tasks would be merged until they hold some bytes of lines, of whatever number."""
        if (self.sf_dir, "lines") in _KEPT:
            return self.lines
        return self.first_lines(self.raw("lineitem").repartition(self.parts, "l_orderkey", "l_linenumber"))

    @role
    def maps(self) -> DataFrame:
        from laddermill.functions.scalars import slug

        family = F.expr("case r_regionkey when 0 then 'open' when 1 then 'closed' when 2 then 'hybrid' when 3 then 'nomad' else 'water' end")
        return self.raw("region").select(F.col("r_regionkey").alias("map_id"), F.col("r_name").alias("name"), slug(F.col("r_name")).alias("slug"), family.alias("family"))

    @role
    def civs(self) -> DataFrame:
        kinds = self.raw("part").select("p_type").distinct()
        return kinds.select(F.row_number().over(W.orderBy("p_type")).alias("civ_id"), F.lower("p_type").alias("slug"))

    @role
    def matches(self) -> DataFrame:
        n = self.lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_players")).filter("n_players >= 2")
        rows = self.placed_orders.join(n, F.expr("l_orderkey = o_orderkey"))
        return rows.selectExpr("o_orderkey match_id", *named(MATCH_SQL))

    @property
    def placed_orders(self) -> DataFrame:
        """Orders with the nation of their customer."""
        where = self.raw("nation").join(self.raw("customer"), F.expr("n_nationkey = c_nationkey"))
        return self.raw("orders").join(where, F.expr("c_custkey = o_custkey"))

    @role
    def players(self) -> DataFrame:
        rows = self.lines.join(self.raw("part").select("p_partkey", F.lower("p_type").alias("slug")), F.expr("p_partkey = l_partkey")).join(self.civs, "slug")
        return rows.selectExpr(*named(PLAYER_SQL))

    @role
    def events(self) -> DataFrame:
        rows = self.player_lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
        pick = lambda ids: f"array({', '.join(map(str, ids))})[cast((l_suppkey + k) % 10 as int)]"
        return rows.selectExpr(
            "l_orderkey match_id",
            "l_linenumber profile_id",
            "cast(((l_partkey * 37 + k * 409 + l_suppkey * 11) % 1800) * 1000 as int) t_ms",
            "case when k % 2 = 0 then 'train' else 'research' end kind",
            f"case when k % 2 = 0 then {pick(TRAINED)} else {pick(RESEARCHED)} end target_id",
            "case when k % 2 = 0 then cast(l_quantity as bigint) % 6 end amount",
        )

    @role
    def units(self) -> DataFrame:
        from laddermill.operators.events import player_units

        return player_units(self.events)

    @role
    def unit_names(self) -> DataFrame:
        """Names of units, a few ids to each."""
        ids = self.spark.range(1, 1000).select(F.col("id").cast("int").alias("unit_id"))
        return ids.join(self.raw("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), F.expr("k = unit_id % 8")).drop("k")

    @role
    def techs(self) -> DataFrame:
        return self.events.filter("kind = 'research'").groupBy("match_id", "profile_id", F.col("target_id").alias("tech_id")).agg(F.min("t_ms").alias("t_ms"))

    def dealt_lines(self) -> Tables:
        """These tables with the lines written once, dealt by order, for queries that make several roles of them."""
        from laddermill.sources.archives import dealt

        return self.with_lines(dealt(self.lines, "lines", "l_orderkey", self.parts))

    def with_lines(self, lines: DataFrame) -> Tables:
        """These tables, with these lines for lines."""
        kept = Tables(self.spark, self.sf_dir)
        kept.__dict__["lines"] = kept.__dict__["player_lines"] = lines
        kept.__dict__["parts"] = self.parts
        return kept

    @property
    def met(self) -> DataFrame:
        """Players with the columns of their match, in `parts` parts by match.

        Lines are shuffled by order once: what comes first of a number, how many play and the order meet there. Their
        parts come before, as lists, so that a part that is there twice makes two players and drops no line.
        """
        if {(self.sf_dir, name) for name in ("lines", "players", "matches")} & _KEPT.keys():
            return self.players.join(self.matches, "match_id").repartition(self.parts, "match_id")
        kinds = self.raw("part").select("p_partkey", F.lower("p_type").alias("slug")).join(self.civs, "slug").groupBy("p_partkey").agg(F.collect_list("civ_id").alias("civ_ids"))
        lines = self.raw("lineitem").join(kinds, F.expr("p_partkey = l_partkey"), "left").repartition(self.parts, "l_orderkey")
        first = self.first_lines(lines).withColumn("n_players", F.count(F.lit(1)).over(W.partitionBy("l_orderkey"))).filter("n_players >= 2")
        rows = first.join(self.placed_orders, F.expr("l_orderkey = o_orderkey")).withColumn("civ_id", F.explode("civ_ids"))
        return rows.selectExpr(*named(PLAYER_SQL | MATCH_SQL))

    @cached_property
    def played(self) -> DataFrame:
        """`met` written once, in buckets by match, for queries that need it several times."""
        from laddermill.sources.archives import bucketed

        return bucketed(self.met, "played", "match_id", self.parts)

    @role
    def ages(self) -> DataFrame:
        return self.ages_of(self.players)

    @staticmethod
    def ages_of(players: DataFrame, *more: str) -> DataFrame:
        """Each player's ages, with more of the player's columns."""
        rows = players.select("match_id", "profile_id", "civ_id", "won", "feudal_t", "castle_t", *more, F.explode(F.array(*map(F.lit, ("dark", "feudal", "castle")))).alias("age"))
        return rows.selectExpr(
            "match_id", "profile_id", "civ_id", "won", "age", *more,
            "case age when 'dark' then 0 when 'feudal' then coalesce(cast(feudal_t * 1000 as int), -1) else coalesce(cast(castle_t * 1000 as int), -1) end uptime_ms",
            "case age when 'dark' then 18 + profile_id else 8 + civ_id end villagers",
        )

    @role
    def sessions(self) -> DataFrame:
        """Events of ten days and eight users, or in every fourth group of eight two, as matches, the users as players; ten days scaled to 30 minutes.

        Half of the researches are age clicks (20, 40, 60).
        """
        day = "datediff(to_date(ts), date '2024-01-01')"
        # in parts, so that the session's time zone plays no part
        millis = f"({day} * 86400000L + hour(ts) * 3600000L + minute(ts) * 60000L + cast(floor(extract(second from ts) * 1000) as bigint))"
        k = "cast(get_json_object(props, '$.k') as int)"
        return self.raw("events").selectExpr(
            "event_id",
            f"cast({day} div 10 + 1000 * (user_id div 8) + case when user_id div 8 % 4 = 3 then 100 * (user_id % 8 div 2) else 0 end as bigint) match_id",
            "user_id profile_id",
            f"({millis} - 864000000 * ({day} div 10)) div 480 t_ms",
            "case event_type when 'click' then 'train' when 'view' then 'research' when 'purchase' then 'build' when 'signup' then 'move' else 'resign' end kind",
            f"case when event_type = 'view' and {k} % 2 = 0 then 20 * (1 + {k} % 3) else {k} end target_id",
            "1 + cast(floor(value / 100) as int) amount",
            "(event_id * 17) % 120 x",
            "(event_id * 29) % 120 y",
        )

    @role
    def session_players(self) -> DataFrame:
        """Each session's players, in two teams by their number, with the length and the kind of map of their match."""
        return self.sessions.select("match_id", "profile_id").distinct().selectExpr("match_id", "profile_id", "cast(2 + profile_id % 2 as int) team", "cast(profile_id % 6 as int) civ_id", "cast(1800000 as bigint) duration_ms", "case (match_id + match_id div 1000) % 4 when 0 then 'open' when 1 then 'closed' when 2 then 'nomad' else 'hybrid' end family")


ROLE_CTES = {
    "l1": """select * exclude rn from (select *, row_number() over (partition by l_orderkey, l_linenumber
        order by l_partkey, l_suppkey, l_extendedprice, l_shipdate) rn from lineitem) where rn = 1""",
    "f_maps": """select r_regionkey map_id, r_name name, lower(regexp_replace(r_name, '[^A-Za-z0-9]', '', 'g')) slug,
        case r_regionkey when 0 then 'open' when 1 then 'closed' when 2 then 'hybrid' when 3 then 'nomad' else 'water' end family from region""",
    "f_civs": "select cast(row_number() over (order by p_type) as int) civ_id, lower(p_type) slug from (select distinct p_type from part)",
    "f_matches": """select o_orderkey match_id, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'replay' else 'archive' end source,
        case when n = 2 then '1v1' else 'team' end ladder, n_regionkey map_id, cast(year(o_orderdate) as int) build, o_orderdate played_at,
        1800000 duration_ms, n n_players
        from orders join (select l_orderkey, count(*) n from l1 group by 1) on l_orderkey = o_orderkey
        join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey where n >= 2""",
    "f_players": """select l_orderkey match_id, l_linenumber profile_id, civ_id,
        case when l_discount >= 0.095 then null else cast(800 + floor(l_extendedprice / 60) as int) end elo,
        case when l_returnflag = 'N' and l_linenumber = 7 then null else l_linestatus = 'F' end won,
        case l_suppkey % 5 when 0 then 'scouts' when 1 then 'archers' when 2 then 'fast_castle' when 3 then 'drush' end opening_kind,
        case when l_suppkey % 11 = 0 then null else 400 + l_quantity * 8 end feudal_t,
        case when l_suppkey % 7 = 0 or l_suppkey % 11 = 0 then null else 700 + l_quantity * 8 + l_partkey % 300 end castle_t,
        case when l_suppkey % 3 = 0 or l_suppkey % 7 = 0 or l_suppkey % 11 = 0 then null else 1300 + l_quantity * 8 + l_partkey % 300 end imperial_t
        from l1 join part on p_partkey = l_partkey join f_civs on slug = lower(p_type)""",
    "f_events": f"""select l_orderkey match_id, l_linenumber profile_id,
        cast(((l_partkey * 37 + k * 409 + l_suppkey * 11) % 1800) * 1000 as int) t_ms, case when k % 2 = 0 then 'train' else 'research' end kind,
        case when k % 2 = 0 then {TRAINED}[cast((l_suppkey + k) % 10 as int) + 1] else {RESEARCHED}[cast((l_suppkey + k) % 10 as int) + 1] end target_id,
        case when k % 2 = 0 then cast(l_quantity as bigint) % 6 end amount from l1, (select unnest(range(0, 6)) k) g""",
    "f_units": """select match_id, profile_id, target_id unit_id, cast(sum(greatest(coalesce(amount, 1), 1)) as bigint) trained
        from f_events where kind = 'train' group by 1, 2, 3""",
    "f_unit_names": "select cast(u as int) as unit_id, n_name as name from nation, (select unnest(range(1, 1000)) u) x where n_nationkey = u % 8",
    "f_techs": "select match_id, profile_id, target_id tech_id, min(t_ms) t_ms from f_events where kind = 'research' group by 1, 2, 3",
    "f_ages": """select match_id, profile_id, civ_id, won, age,
        case age when 'dark' then 0 when 'feudal' then coalesce(cast(feudal_t * 1000 as int), -1) else coalesce(cast(castle_t * 1000 as int), -1) end uptime_ms,
        case age when 'dark' then 18 + profile_id else 8 + civ_id end villagers from f_players, (select unnest(['dark', 'feudal', 'castle']) age) a""",
    "f_sessions": """select event_id, date_diff('day', timestamp '2024-01-01', ts) // 10 + 1000 * (user_id // 8) + case when user_id // 8 % 4 = 3 then 100 * (user_id % 8 // 2) else 0 end match_id, user_id profile_id,
        (epoch_us(ts) // 1000 - 1704067200000 - 864000000 * (date_diff('day', timestamp '2024-01-01', ts) // 10)) // 480 t_ms,
        case event_type when 'click' then 'train' when 'view' then 'research' when 'purchase' then 'build' when 'signup' then 'move' else 'resign' end kind,
        case when event_type = 'view' and cast(json_extract(props, '$.k') as int) % 2 = 0 then 20 * (1 + cast(json_extract(props, '$.k') as int) % 3) else cast(json_extract(props, '$.k') as int) end target_id, 1 + cast(floor(value / 100) as int) amount, (event_id * 17) % 120 x, (event_id * 29) % 120 y from events""",
    "f_session_players": """select distinct match_id, profile_id, cast(2 + profile_id % 2 as int) team, cast(profile_id % 6 as int) civ_id,
        cast(1800000 as bigint) duration_ms, case (match_id + match_id // 1000) % 4 when 0 then 'open' when 1 then 'closed' when 2 then 'nomad' else 'hybrid' end as family from f_sessions""",
    "f_rated": """select *, case when elo < 1000 then '<1000' when elo < 1200 then '1000-1199' when elo < 1400 then '1200-1399' when elo < 1650 then '1400-1649'
        when elo < 1800 then '1650-1799' when elo < 2000 then '1800-1999' when elo < 2200 then '2000-2199' when elo < 2500 then '2200-2499'
        when elo is not null then '2500+' end elo_bucket from f_players""",
}


def twin(select: str, **more: str) -> str:
    """DuckDB text of a query over the roles; more: further tables by name, in order."""
    return "with " + ", ".join(f"{name} as ({sql})" for name, sql in (ROLE_CTES | more).items()) + " " + select
