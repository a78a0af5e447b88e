"""The event contract: names, enums, reason codes, limits and the item dimension.

Everything in this file is a fixed value that callers and stored data rely on.
"""

from __future__ import annotations

# --- fixed values: event types and common fields -------------------------------------------------

EVENT_NAMES = (
    "run_started",
    "upgrade_options_shown",
    "upgrade_selected",
    "run_checkpoint",
    "run_ended",
)

COMMON_FIELDS = (
    "event_id",
    "event_name",
    "source_type",
    "run_id",
    "event_sequence",
    "run_elapsed_seconds",
    "game_version",
    "schema_version",
)

# --- fixed values: enums -------------------------------------------------------------------------

SOURCE_TYPES = ("CONSENTED_PROD_PLAY", "CONTROLLED_SCENARIO", "LOAD_TEST")
PRODUCT_SOURCE = "CONSENTED_PROD_PLAY"
CHOICE_SOURCES = ("level_up_weapon", "level_up_upgrade", "statue")
RARITIES = ("common", "uncommon", "rare", "epic", "legendary")
STATUE_ITEMS = (
    "horseshoe",
    "gold_ingot",
    "hourglass",
    "sword",
    "bull_skull",
    "sticky_bone",
    "greyhound_tooth",
    "blood_scent",
)
END_REASONS = (
    "player_death",
    "player_quit",
    "player_restart",
    "run_completed",
    "application_closed",
    "unknown",
)
DEATH_CAUSES = ("enemy_damage", "fall", "environmental_hazard", "unknown")

# --- fixed values: reason codes and run statuses -------------------------------------------------

INVALID_JSON = "invalid_json"
SCHEMA_INVALID = "schema_invalid"
PROHIBITED_FIELD = "prohibited_field"
DUPLICATE_CONFLICT = "duplicate_conflict"
CORRELATION_MISMATCH = "correlation_mismatch"
MISSING_RUN_START = "missing_run_start"
MISSING_RUN_END = "missing_run_end"
EVENT_SEQUENCE_GAP = "event_sequence_gap"
EVENT_SEQUENCE_CONFLICT = "event_sequence_conflict"
EVENT_ORDER_INVALID = "event_order_invalid"
CHOICE_NOT_FOUND = "choice_not_found"
CHOICE_MISMATCH = "choice_mismatch"
COUNTER_DECREASED = "counter_decreased"
EVENT_ARRIVAL_TOO_LATE = "event_arrival_too_late"

# A run whose only issues carry these codes is incomplete; any other code makes it invalid.
INCOMPLETE_CODES = (
    MISSING_RUN_START,
    MISSING_RUN_END,
    EVENT_SEQUENCE_GAP,
    CHOICE_NOT_FOUND,
)

VALID, INCOMPLETE, INVALID = "valid", "incomplete", "invalid"

# Counters that may never fall within a run.
MONOTONIC_COUNTERS = (
    "run_elapsed_seconds",
    "total_kills",
    "total_xp_collected",
    "total_gold_collected",
    "hearts_collected",
    "total_healing_received",
    "magnets_collected",
    "miniboss_waves_cleared",
)

# Fields every event of a run must share with the run's first start.
CORRELATION_FIELDS = ("run_id", "game_version", "schema_version", "source_type")

# --- fixed values: limits ------------------------------------------------------------------------

SCHEMA_VERSION = "2.0"
BRONZE_RECORD_VERSION = 1
MAX_BODY_BYTES = 64 * 1024
MAX_UPGRADE_STATES = 64
ALLOWED_LATENESS = "24 hours"
RETENTION_DAYS = 30
CHECKPOINT_SECONDS = 60
MIN_SAMPLE = 30

# --- fixed values: which channel may deliver which source type -----------------------------------

CHANNEL_SOURCES = (
    ("turkiye_gateway", "CONSENTED_PROD_PLAY"),
    ("turkiye_gateway", "CONTROLLED_SCENARIO"),
    ("scenario_generator", "CONTROLLED_SCENARIO"),
    ("load_test_runner", "LOAD_TEST"),
)

# --- fixed values: normalised key names that may identify a person or device ---------------------

PROHIBITED_KEYS = (
    "accountdata", "accountid", "accountidentifier", "auth", "authenticationtoken", "authorization", "authtoken",
    "cfconnectingip", "chat", "chatcontent", "clientip", "cookie", "deviceid", "deviceidentifier", "discordid",
    "email", "emailaddress", "filepath", "fingerprint", "forwarded", "fullname", "gps", "hardwareid",
    "hardwareuuid", "headers", "installationid", "installationidentifier", "ip", "ipaddress", "latitude",
    "location", "longitude", "mac", "macaddress", "machineid", "machineidentifier", "name", "nickname",
    "operatingsystemusername", "originalheaders", "persistentid", "persistentidentifier", "phone", "phonenumber",
    "playerid", "playeridentifier", "preciselocation", "referer", "requestheaders", "session", "sessionid",
    "sessiontoken", "sourceip", "steamaccountid", "steamid", "steamnickname", "token", "trueclientip", "useragent",
    "userid", "useridentifier", "username", "xforwardedfor", "xrealip",
)

# --- fixed values: the aggregate export document -------------------------------------------------

EXPORT_SCHEMA_VERSION = "aggregate-export-v1"
EXPORT_SOURCE_REGION = "TR"
EXPORT_DESTINATION_REGION = "ap-southeast-2"
EXPORT_PRIVACY_MODE = "aggregate_only"
EXPORT_DATA_CLASSES = ("SYNTHETIC_TEST", "PRIVACY_RELEASED_PROD_AGGREGATE")

# --- fixed values: the report document -----------------------------------------------------------

REPORT_SCHEMA_VERSION = "gold-report-input-v1"
REPORT_MAX_BYTES = 24 * 1024
REPORT_MAX_TEXT = 128

# --- fixed values: the item dimension (choice_source | item_id | display_name | item_category |
#     intended_effect | primary_metric | rarity_scaled | metric_readiness), game version 0.1.0 -----

ITEM_CATALOG_VERSION = "0.1.0"

ITEM_ROWS = (
    ("level_up_weapon", "bone", "Bone",
     "weapon", "Fast homing projectiles", "kills_per_minute_after_selection", False, "DERIVABLE"),
    ("level_up_weapon", "tennis_ball", "Tennis Ball",
     "weapon", "Fast ricocheting projectiles", "kills_per_minute_after_selection", False, "DERIVABLE"),
    ("level_up_weapon", "steak", "Steak",
     "weapon", "Tracking automatic projectiles", "kills_per_minute_after_selection", False, "DERIVABLE"),
    ("level_up_weapon", "fireball", "Fireball",
     "weapon", "Slow long-lived homing projectiles", "kills_per_minute_after_selection", False, "DERIVABLE"),
    ("level_up_upgrade", "bone_extra_projectiles", "Bone Extra Projectiles",
     "offense_projectile_count", "Increase projectiles per attack", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "bone_attack_speed_multiplier", "Bone Attack Speed",
     "offense_attack_speed", "Increase automatic attack frequency", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "bone_damage_bonus", "Bone Damage",
     "offense_damage", "Increase projectile damage", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "tennis_ball_extra_projectiles", "Tennis Ball Extra Projectiles",
     "offense_projectile_count", "Increase projectiles per attack", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "tennis_ball_attack_speed_multiplier", "Tennis Ball Attack Speed",
     "offense_attack_speed", "Increase automatic attack frequency", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "tennis_ball_damage_bonus", "Tennis Ball Damage",
     "offense_damage", "Increase projectile damage", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "steak_extra_projectiles", "Steak Extra Projectiles",
     "offense_projectile_count", "Increase projectiles per attack", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "steak_attack_speed_multiplier", "Steak Attack Speed",
     "offense_attack_speed", "Increase automatic attack frequency", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "steak_damage_bonus", "Steak Damage",
     "offense_damage", "Increase projectile damage", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "fireball_extra_projectiles", "Fireball Extra Projectiles",
     "offense_projectile_count", "Increase projectiles per attack", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "fireball_attack_speed_multiplier", "Fireball Attack Speed",
     "offense_attack_speed", "Increase automatic attack frequency", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("level_up_upgrade", "fireball_damage_bonus", "Fireball Damage",
     "offense_damage", "Increase projectile damage", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("statue", "horseshoe", "Horseshoe",
     "rarity_luck", "Increase the chance of higher-rarity options", "subsequent_high_rarity_option_rate", True, "DERIVABLE"),
    ("statue", "gold_ingot", "Gold Ingot",
     "economy", "Increase gold gained from coins", "gold_gain_after_selection", True, "LIMITED_BY_CHECKPOINT_CADENCE"),
    ("statue", "hourglass", "Hourglass",
     "progression", "Increase experience gained from XP orbs", "xp_gain_after_selection", True, "LIMITED_BY_CHECKPOINT_CADENCE"),
    ("statue", "sword", "Sword",
     "offense_damage", "Increase final damage for all weapons", "kills_per_minute_after_selection", True, "DERIVABLE"),
    ("statue", "bull_skull", "Bull Skull",
     "risk_reward", "Advance difficulty time", "progression_and_death_rate_after_selection", True, "DERIVABLE"),
    ("statue", "sticky_bone", "Sticky Bone",
     "offense_chain", "Chain a projectile to additional enemies after the first hit", "kills_per_minute_after_selection", False, "DERIVABLE"),
    ("statue", "greyhound_tooth", "Greyhound Tooth",
     "offense_execute", "Chance to execute a non-boss enemy", "kills_per_minute_after_selection", False, "DERIVABLE"),
    ("statue", "blood_scent", "Blood Scent",
     "offense_execute", "Execute enemies below the configured health threshold", "kills_per_minute_after_selection", False, "DERIVABLE"),
)

#: (item_id, display_name, intended_effect) of the four weapons.
WEAPONS = tuple((row[1], row[2], row[4]) for row in ITEM_ROWS if row[0] == "level_up_weapon")


def item_rows() -> list[tuple]:
    """The 24 item attributes without their game version."""
    return list(ITEM_ROWS)
