"""The given `events` table read as run telemetry.

Every row of the table is an event of some run. Its place follows from its event_id alone, so the projection needs neither a
window nor a shuffle: 24 consecutive ids are one run or two of different lengths, and each sixth stretch of 1,200 ids is one
long run. Missing ends and gaps come from the type and the number an event gets, not from leaving rows out. One SQL text serves Spark and DuckDB; only the few spellings in `Dialect` differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.sources.catalog import for_versions
from runtrace.sources.staging import exists, new_folder

RUN_LENGTH = 24
LONG_RUN = 1200
VERSIONS = ("1.0.0", "1.1.0", "1.2.0")


@dataclass(frozen=True)
class Dialect:
    k: str
    text: str
    micros: str
    day: str
    element: str

    def div(self, a: str, b: int) -> str:
        return f"cast(floor(({a}) / {b}.0) as bigint)"


SPARK = Dialect(
    k="cast(get_json_object(props, '$.k') as bigint)",
    text="string",
    micros="unix_micros(cast(ts as timestamp))",
    day="cast(ts as date)",
    element="try_element_at(array({0}), cast({1} as int) + 1)",
)
DUCKDB = Dialect(
    k="cast(json_extract(props, '$.k') as bigint)",
    text="varchar",
    micros="epoch_us(ts)",
    day="cast(ts as date)",
    element="list_element([{0}], cast({1} as int) + 1)",
)


def pick(index: str, names, d: Dialect) -> str:
    """A name by its position in a short list; NULL beyond its end."""
    return d.element.format(", ".join(f"'{name}'" for name in names), index)


def uuid(prefix: str, number: str, d: Dialect) -> str:
    return f"concat('{prefix}-0000-4000-8000-', lpad(cast({number} as {d.text}), 12, '0'))"


def _items(slot: int, d: Dialect) -> str:
    weapons = [w[0] for w in contract.WEAPONS]
    upgrades = [row[1] for row in contract.item_rows() if row[0] == "level_up_upgrade"]
    return (
        "CASE choice_source "
        f"WHEN 'level_up_weapon' THEN {pick(f'((h + {slot - 1}) % 4)', weapons, d)} "
        f"WHEN 'level_up_upgrade' THEN {pick(f'((h + {5 * (slot - 1)}) % 12)', upgrades, d)} "
        f"ELSE {pick(f'((h + {3 * (slot - 1)}) % 8)', contract.STATUE_ITEMS, d)} END"
    )


def telemetry_sql(d: Dialect, source: str = "events", faults: bool = False) -> str:
    """A WITH list ending in `telemetry`: one typed row per event.

    With `faults`, every second run carries deliberate contract and sequence faults chosen by event_id, so that
    each rule has rows to find.
    """
    weapons = [w[0] for w in contract.WEAPONS]

    def fault(condition: str, changed: str, normal: str) -> str:
        return f"CASE WHEN {condition} THEN {changed} ELSE {normal} END" if faults else normal

    odd = "r % 4 = 3"  # runs with sequence faults
    dirty = "r % 4 = 1"  # runs with contract faults
    rarity = [pick(f"((h + {slot}) % 5)", contract.RARITIES, d) for slot in (1, 2, 3)]
    number = fault(f"{odd} AND r % 5 = 2 AND p > 5", "p + 1", "p")
    early = (
        f" WHEN {odd} AND r % 7 = 5 AND p = 1 THEN 'upgrade_options_shown'"
        f" WHEN {odd} AND r % 7 = 5 AND p = 2 THEN 'run_started'"
        if faults
        else ""
    )
    return f"""
raw AS (
  SELECT event_id AS n, {d.div('event_id', RUN_LENGTH)} AS block, event_id % {RUN_LENGTH} + 1 AS q,
         {d.div('event_id', LONG_RUN)} AS stretch, {d.micros} AS us, {d.day} AS day, value, {d.k} AS k
  FROM {source}
),
cut AS (
  SELECT raw.*, stretch % 6 = 4 AS long, CASE block % 5 WHEN 1 THEN 20 WHEN 2 THEN 14 WHEN 4 THEN 8 ELSE 24 END AS first_end
  FROM raw
),
kept AS (
  SELECT cut.*,
    CASE WHEN long THEN 10 * stretch WHEN q <= first_end THEN block ELSE block + 3 END AS r,
    CASE WHEN long THEN {2 * LONG_RUN // RUN_LENGTH} * stretch WHEN q <= first_end THEN 2 * block ELSE 2 * block + 1 END AS u,
    CASE WHEN long THEN n % {LONG_RUN} + 1 WHEN q <= first_end THEN q ELSE q - first_end END AS p,
    CASE WHEN long THEN {LONG_RUN} WHEN q <= first_end THEN first_end ELSE {RUN_LENGTH} - first_end END AS e
  FROM cut
),
named AS (
  SELECT kept.*,
    CASE WHEN p = e AND r % 6 > 0 THEN 'run_ended'{early}
         WHEN r % 7 = 3 AND p = 1 THEN 'upgrade_options_shown'
         WHEN r % 7 = 3 AND p = 2 THEN 'upgrade_selected'
         WHEN r % 7 = 3 AND p = 3 THEN 'run_started'
         WHEN p = 1 THEN 'run_started'
         WHEN p % 6 = 0 THEN 'run_checkpoint'
         WHEN p % 6 IN (3, 5) THEN 'upgrade_selected'
         ELSE 'upgrade_options_shown' END AS base_name
  FROM kept
),
placed AS (
  SELECT named.*,
    {fault(f"{odd} AND n % 73 = 0 AND base_name = 'upgrade_options_shown'", "'run_ended'", "base_name")} AS event_name,
    CASE WHEN base_name = 'upgrade_options_shown' THEN p WHEN base_name = 'upgrade_selected' THEN p - 1 END AS cp
  FROM named
),
chosen AS (
  SELECT placed.*, r * 31 + cp * 7 AS h,
    CASE WHEN event_name NOT IN ('upgrade_options_shown', 'upgrade_selected') THEN NULL
         WHEN r % 7 = 3 AND p <= 2 THEN 'level_up_weapon'
         WHEN (r * 31 + cp * 7) % 5 <= 1 THEN 'level_up_weapon'
         WHEN (r * 31 + cp * 7) % 5 <= 3 THEN 'level_up_upgrade'
         ELSE 'statue' END AS choice_source
  FROM placed
),
offered AS (
  SELECT chosen.*,
    CASE WHEN choice_source = 'statue' THEN 1 + h % 3 WHEN choice_source IS NOT NULL THEN 1 + h % 2 END AS slot,
    {_items(1, d)} AS item_1, {_items(2, d)} AS item_2,
    CASE WHEN choice_source = 'statue' THEN {_items(3, d)} END AS item_3,
    {rarity[0]} AS rarity_1, {rarity[1]} AS rarity_2,
    CASE WHEN choice_source = 'statue' THEN {rarity[2]} END AS rarity_3
  FROM chosen
),
telemetry AS (
  SELECT n, r, u, p, e, k, us, day, event_name,
    {uuid('10000000', 'n', d)} AS event_id,
    {uuid('30000000', 'u', d)} AS run_id,
    CASE r % 10 WHEN 0 THEN 'LOAD_TEST' WHEN 1 THEN 'CONTROLLED_SCENARIO' ELSE 'CONSENTED_PROD_PLAY' END AS source_type,
    {fault(f"{odd} AND n % 71 = 0", "'9.9.9'", pick('(r % 3)', VERSIONS, d))} AS game_version,
    '2.0' AS schema_version,
    cast({fault(f"{odd} AND n % 61 = 0 AND p > 1", f"{number} - 1", number)} as bigint) AS event_sequence,
    cast(CASE WHEN p = 1 OR (r % 7 = 3 AND p <= 3) OR event_name = 'run_started' THEN 0
              WHEN event_name = 'run_checkpoint' THEN
                {fault(f"{odd} AND n % 79 = 0", "10 * p + 5", "10 * p")}
              ELSE 10 * p + (k % 4) * 0.25 END as double) AS run_elapsed_seconds,
    {fault(f"{odd} AND n % 101 = 0 AND event_name = 'upgrade_selected'", uuid('50000000', 'n', d),
           fault(f"{odd} AND n % 109 = 0 AND event_name = 'upgrade_options_shown' AND p % 6 = 4",
                 uuid('40000000', '(u * 10000 + cp - 2)', d),
                 f"CASE WHEN choice_source IS NOT NULL THEN {uuid('40000000', '(u * 10000 + cp)', d)} END"))} AS choice_id,
    cast({fault(f"{odd} AND n % 107 = 0 AND event_name = 'upgrade_options_shown'", "1",
                "CASE WHEN choice_source IS NOT NULL THEN cp END")} as bigint) AS choice_sequence,
    choice_source,
    item_1,
    {fault(f"{dirty} AND n % 19 = 0 AND choice_source = 'statue'", "item_1", "item_2")} AS item_2,
    item_3,
    {fault(f"{dirty} AND n % 97 = 0 AND event_name = 'upgrade_options_shown'", "'mythic'", "rarity_1")} AS rarity_1,
    rarity_2, rarity_3,
    CASE WHEN event_name = 'upgrade_selected' THEN slot END AS selected_slot,
    CASE WHEN event_name = 'upgrade_selected' THEN
      CASE slot WHEN 1 THEN item_1 WHEN 2 THEN item_2 ELSE item_3 END END AS selected_item_id,
    CASE WHEN event_name = 'upgrade_selected' THEN
      {fault(f"{odd} AND n % 103 = 0", "'legendary'",
             "CASE slot WHEN 1 THEN rarity_1 WHEN 2 THEN rarity_2 ELSE rarity_3 END")} END AS selected_rarity,
    CASE WHEN event_name = 'run_checkpoint' THEN {d.div('p', 6)} END AS checkpoint_number,
    CASE WHEN event_name = 'run_checkpoint' THEN p + k % 5 END AS player_level,
    CASE WHEN event_name = 'run_checkpoint' THEN value END AS current_xp,
    CASE WHEN event_name = 'run_checkpoint' THEN cast(10 + k as double) END AS xp_to_next_level,
    CASE WHEN event_name = 'run_checkpoint' THEN cast(k as double) END AS hp_percent,
    CASE WHEN event_name IN ('run_checkpoint', 'run_ended') THEN
      {fault(f"{odd} AND n % 67 = 0", "0", "p * 10 + k % 10")} END AS total_kills,
    CASE WHEN event_name IN ('run_checkpoint', 'run_ended') THEN value * 2 END AS current_gold,
    CASE WHEN event_name IN ('run_checkpoint', 'run_ended') THEN cast(p * 100 + k as double) END AS total_xp_collected,
    CASE WHEN event_name IN ('run_checkpoint', 'run_ended') AND r % 2 = 0 THEN cast(p * 50 + k % 50 as double) END
      AS total_gold_collected,
    CASE WHEN event_name = 'run_ended' THEN
      {fault(f"{odd} AND n % 5 = 0", "0", "p")} END AS hearts_collected,
    CASE WHEN event_name = 'run_ended' THEN {pick('(k % 6)', contract.END_REASONS, d)} END AS end_reason,
    CASE WHEN event_name = 'run_ended' AND k % 6 = 0 THEN
      {pick(f"({d.div('k', 6)} % 5)", contract.DEATH_CAUSES, d)} END AS death_cause,
    CASE WHEN event_name = 'run_ended' THEN p + k % 5 END AS final_level,
    CASE WHEN event_name = 'run_ended' AND k % 2 = 0 THEN {pick('(k % 8)', contract.STATUE_ITEMS, d)} END AS final_item,
    CASE WHEN event_name = 'run_ended' AND k % 2 = 0 THEN 1 + k % 3 END AS final_acquisitions,
    CASE WHEN event_name = 'run_started' AND r % 2 = 0 THEN 'map_1' END AS map_id,
    CASE WHEN event_name = 'run_started' THEN cast(100 + k as double) END AS starting_max_hp,
    CASE WHEN event_name = 'run_started' AND r % 11 > 0 THEN {pick('(r % 4)', weapons, d)} END AS starting_weapon_id,
    CASE WHEN r % 10 = 0 THEN 'load_test_runner'
         WHEN r % 20 = 1 THEN 'scenario_generator' ELSE 'turkiye_gateway' END AS ingestion_channel,
    cast(CASE WHEN {'true' if faults else 'false'} AND {dirty} AND n % 83 = 0 THEN 1 ELSE 0 END as bigint) AS has_device_id,
    cast(CASE WHEN {'true' if faults else 'false'} AND {dirty} AND n % 89 = 0 THEN 1 ELSE 0 END as bigint) AS has_unknown_key
  FROM offered
)"""


def deliveries_sql(d: Dialect, source: str = "events") -> str:
    """A WITH list ending in `deliveries`: every arrival, with retries, conflicting bodies, late arrivals and
    events delivered again under another run. `body` tells apart the bodies of one event_id."""
    columns = "r, p, event_name, source_type, schema_version, event_sequence, run_elapsed_seconds, choice_id, " \
        "choice_sequence, choice_source, item_1, item_2, item_3, rarity_1, rarity_2, rarity_3, selected_slot, " \
        "selected_item_id, selected_rarity, checkpoint_number, player_level, current_xp, xp_to_next_level, " \
        "hp_percent, total_kills, current_gold, total_xp_collected, total_gold_collected, hearts_collected, " \
        "end_reason, death_cause, final_level, final_item, final_acquisitions, map_id, starting_max_hp, " \
        "starting_weapon_id, ingestion_channel, has_device_id, has_unknown_key"
    minute = 60_000_000
    late = f"CASE WHEN r % 8 = 7 AND n % 53 = 0 THEN us + {2 * 24 * 60 * minute} ELSE us END"
    return telemetry_sql(d, source, faults=True) + f""",
deliveries AS (
  SELECT n, 0 AS body, event_id, run_id, game_version, {late} AS received_us, {columns} FROM telemetry
  UNION ALL
  SELECT n, 0, event_id, run_id, game_version, {late} + {5 * minute}, {columns} FROM telemetry
  WHERE n % 37 = 0
  UNION ALL
  SELECT n, 1, event_id, run_id, '1.9.0',
         {late} + CASE WHEN n % 2 = 0 THEN {-1 * minute} ELSE {10 * minute} END, {columns} FROM telemetry
  WHERE n % 41 = 0 AND r % 4 = 3
  UNION ALL
  SELECT n, 2, event_id, {uuid('30000000', '(u + 2)', d)}, game_version, {late} + {minute}, {columns} FROM telemetry
  WHERE n % 127 = 0 AND r % 16 = 2
)"""


#: A row of `events` becomes about a KB of JSON several times over, so far fewer rows make a task than a Parquet split has.
FEW_ROWS, MANY_ROWS = 20_000, 200_000


def tasks_for(rows: int, cores: int) -> int:
    """Tasks that share the rows of `events`: three for each core if none gets too few rows, more if any got too many."""
    return max(min(-(-rows // FEW_ROWS), 3 * cores), -(-rows // MANY_ROWS), 1)


#: HotSpot never compiles a method over 8,000 bytes: the wide projections below are cut into functions that it does compile. Groupings are
#: quicker as one method, so Spark's default holds for whatever reads the stored input.
INPUT_METHOD, DEFAULT_METHOD = "8000", "65535"

#: Stored JSON packs ten to one, so that a Parquet split of the usual 128 MB would be over a GB of rows to sort.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": DEFAULT_METHOD,
    "spark.sql.files.maxPartitionBytes": "32m",
}


def settle_session(spark: SparkSession) -> None:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `events`, dealt evenly however few row groups the file has: the narrow rows are shuffled, not the JSON."""
    settle_session(spark)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", INPUT_METHOD)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.repartition(tasks_for(rows.count(), spark.sparkContext.defaultParallelism), "event_id")


def telemetry(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    text = f"WITH {telemetry_sql(SPARK, '{source}', faults)} SELECT * FROM telemetry"
    return spark.sql(text, source=_read(spark, sf_dir))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"WITH {deliveries_sql(SPARK, '{source}')} SELECT * FROM deliveries", source=_read(spark, sf_dir))


def payload():
    """The event-specific members; to_json leaves out those that are NULL."""
    option = lambda slot: F.struct(
        F.lit(slot).alias("slot"), F.col(f"item_{slot}").alias("item_id"), F.col(f"rarity_{slot}").alias("rarity")
    )
    options = F.when(
        F.col("event_name") == "upgrade_options_shown",
        F.when(F.col("item_3").isNotNull(), F.array(option(1), option(2), option(3))).otherwise(
            F.array(option(1), option(2))
        ),
    )
    upgrades = F.when(
        F.col("final_item").isNotNull(),
        F.array(F.struct(F.col("final_acquisitions").alias("acquisition_count"), F.col("final_item").alias("item_id"))),
    )
    context = F.when(
        F.col("has_device_id") == 1, F.struct(F.array(F.struct(F.lit("x1").alias("Device-Id"))).alias("items"))
    )
    return [
        *[F.col(name) for name in (
            "choice_id", "choice_sequence", "choice_source", "selected_slot", "selected_item_id", "selected_rarity",
            "checkpoint_number", "player_level", "current_xp", "xp_to_next_level", "hp_percent", "total_kills",
            "current_gold", "total_xp_collected", "total_gold_collected", "hearts_collected", "end_reason",
            "death_cause", "final_level", "map_id", "starting_max_hp", "starting_weapon_id")],
        options.alias("options"),
        upgrades.alias("final_upgrades"),
        context.alias("context"),
        F.when(F.col("has_unknown_key") == 1, F.lit(1)).alias("unreviewed_metric"),
    ]


def event_json():
    common = ["event_id", "event_name", "source_type", "run_id", "event_sequence", "run_elapsed_seconds",
              "game_version", "schema_version"]
    return F.to_json(F.struct(*common, *payload()))


MISSING_END_JSON = (
    '[{"code":"missing_run_end","event_id":null,"message":"The sequence contains no run_ended event","path":[]}]'
)


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The folder of an input table, written once per session and folder; queries then read it as Parquet or text."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED or not exists(spark, _STORED[key]):
        _STORED[key] = new_folder(spark, name)
        write(_STORED[key])
    return _STORED[key]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored Silver table that Gold reads."""
    path = stored(
        spark, sf_dir, "silver", lambda to: silver_rows(spark, sf_dir).write.partitionBy("received_date").parquet(to)
    )
    settle_session(spark)
    return spark.read.parquet(path)


def bronze_folder(spark: SparkSession, sf_dir: str) -> str:
    """The stored Bronze lines: gzip text by receipt date, as a stream sink leaves them."""
    return stored(
        spark,
        sf_dir,
        "bronze",
        lambda to: bronze_lines(spark, sf_dir).write.partitionBy("received_date").option("compression", "gzip").text(to),
    )


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean telemetry in the Silver layout: what a rebuild of faultless deliveries would hold."""
    ended = F.col("r") % 6 != 0
    unique = F.col("e")
    retries, conflicts = F.col("r") % 3, F.when(F.col("r") % 13 == 0, 1).otherwise(0)
    return telemetry(spark, sf_dir).select(
        "run_id", "event_id", "event_name", "event_sequence", "run_elapsed_seconds", "source_type", "game_version",
        "schema_version",
        F.when(ended, "valid").otherwise("incomplete").alias("run_status"),
        F.timestamp_micros("us").alias("first_received_at"),
        "ingestion_channel",
        F.to_json(F.struct(*payload())).alias("event_payload_json"),
        F.when(ended, "[]").otherwise(MISSING_END_JSON).alias("quality_issues_json"),
        (unique + retries + conflicts).cast("bigint").alias("input_event_count"),
        unique.cast("bigint").alias("unique_event_count"),
        retries.cast("bigint").alias("exact_retry_count"),
        conflicts.cast("bigint").alias("conflicting_duplicate_count"),
        F.col("day").alias("received_date"),
    )


def lines_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as Bronze lines with the number of their source row."""
    received = F.concat(
        F.date_format(F.timestamp_micros("received_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")
    )
    return deliveries(spark, sf_dir).select(
        "n",
        F.concat(
            F.lit('{"bronze_record_version":1,"event":'),
            event_json(),
            F.lit(',"metadata":{"received_at":"'),
            received,
            F.lit('","ingestion_channel":"'),
            F.col("ingestion_channel"),
            F.lit('"}}'),
        ).alias("value"),
        F.to_date(F.timestamp_micros("received_us")).alias("received_date"),
    )


def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as the JSON lines a stream would have stored."""
    return lines_by_number(spark, sf_dir).drop("n")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item dimension for every game version that occurs in the data."""
    return for_versions(silver(spark, sf_dir).select("game_version"))
