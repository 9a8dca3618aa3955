"""Record layouts, geo levels, time grains and the table registry."""

from __future__ import annotations

from dataclasses import dataclass

# Slim message envelope, one JSON object per line; `coordinates` is [lon, lat].  These fields become
# message columns; the parser skips all others.
MESSAGE_FIELDS = (
    "struct<id_str:string,timestamp_ms:string,text:string,coordinates:array<double>,"
    "entities:struct<hashtags:array<string>,user_mentions:array<string>>,"
    "user:struct<id_str:string,screen_name:string>,place:struct<name:string,country_code:string>>"
)

# Raw status as the API sends it.  List elements stay variants: one malformed
# element must not void the whole list, which a struct element type would do.
RAW_STATUS = (
    "struct<id_str:string,timestamp_ms:string,text:string,"
    "coordinates:struct<coordinates:array<double>>,"
    "entities:struct<hashtags:array<variant>,user_mentions:array<variant>>,"
    "user:struct<id_str:string,screen_name:string,location:string>,"
    "place:struct<place_type:string,name:string,country_code:string,full_name:string>>"
)

REQUIRED_KEYS = ("id_str", "timestamp_ms", "text")

# Geo lattice city < country < world: the key columns each level adds to the slot.
LEVEL_KEYS = {"world": (), "country": ("country",), "city": ("country", "city")}
LEVELS = tuple(LEVEL_KEYS)

# Time grains: slot column and its type.  Slots are calendar integers.
GRAIN_SLOT = {"day": "dayslot", "hour": "hourslot", "minute": "minuteslot"}
GRAINS = tuple(GRAIN_SLOT)
SLOT_TYPE = {"dayslot": "int", "hourslot": "int", "minuteslot": "bigint"}

TOP_K = 20


@dataclass(frozen=True)
class Table:
    """One serving table: a parquet folder partitioned by `partitions`.

    `columns` is the table's public layout.  A table with a `ttl` (seconds) also
    stores `written_at` (microseconds), which reads use to hide expired rows.  It is a
    number, as Parquet footers hold the greatest of a file only for numbers.  Streams write the
    tables partitioned by `batch`: a batch that is run again replaces its own rows.

    `key` names the columns that tell rows apart where single rows are replaced.
    Files hold a Bloom filter of each `lookup` column.
    """

    name: str
    columns: dict[str, str]
    partitions: tuple[str, ...]
    sort: tuple[str, ...] = ()
    ttl: int | None = None
    key: tuple[str, ...] = ()
    lookup: tuple[str, ...] = ()

    @property
    def in_batches(self) -> bool:
        return "batch" in self.partitions

    @property
    def slot(self) -> str:
        """The column lookups select a slot by."""
        return "minuteslot" if "minuteslot" in self.columns else self.partitions[0]

    def folder(self, slot: int) -> str:
        """The partition folder of a slot; minute trends share their hour's."""
        first = self.partitions[0]
        shared = first == "hourslot" and "minuteslot" in self.columns
        return f"{first}={slot // 100 if shared else slot}"

    @property
    def ddl(self) -> str:
        stored = dict(self.columns)
        if self.ttl is not None:
            stored["written_at"] = "bigint"
        for p in self.partitions:
            stored.setdefault(p, SLOT_TYPE.get(p, "string"))
        return ", ".join(f"`{c}` {t}" for c, t in stored.items())


def _geo(level: str) -> dict[str, str]:
    return {k: "string" for k in LEVEL_KEYS[level]}


# Seconds a row of each family stays visible (None = for ever).
TREND_TTL = {"day": None, "hour": 86400, "minute": 300}
TOP_TTL = {"day": None, "hour": 86400, "minute": 1200}
COUNTS_TTL = {"day": None, "hour": 86400}
LIVE_LOCATION_TTL = {"world": 120, "country": 120, "city": 120}
# Of live rows the last one of a second and message time counts, whatever its place.
LIVE_KEY = ("secslot", "time_ms")
LIVE_MESSAGE_TTL = {"world": 180, "country": 120, "city": 120}


def trends_name(level: str, grain: str) -> str:
    return f"{level}_{grain}_trends"


def top_name(level: str, grain: str) -> str:
    return f"{level}_{grain}_top_trends"


def sketches_name(grain: str) -> str:
    return f"world_{grain}_sketches"


def counts_name(grain: str) -> str:
    return f"world_{grain}_counts"


def live_locations_name(level: str) -> str:
    return f"rt_tweet_locations_{level}"


def live_messages_name(level: str) -> str:
    return f"rt_tweet_{level}"


def locations_name(level: str) -> str:
    return f"tweet_locations_{level}"


def _registry() -> dict[str, Table]:
    tables = []
    for grain, slot in GRAIN_SLOT.items():
        # A folder per minute would be thousands of tiny folders after a backlog; a lookup lists one hour.
        parts = ("hourslot", "batch") if grain == "minute" else (slot,)
        for level, keys in LEVEL_KEYS.items():
            columns = {slot: SLOT_TYPE[slot], **_geo(level), "topic": "string", "count": "bigint"}
            sort = (*keys, "topic") if grain != "minute" else (slot, *keys, "topic")
            key = (slot, *keys, "topic")
            tables.append(Table(trends_name(level, grain), columns, parts, sort, TREND_TTL[grain], key, ("topic",)))
            tables.append(Table(top_name(level, grain), columns, parts, sort, TOP_TTL[grain], key))
        if grain in COUNTS_TTL:
            columns = {slot: SLOT_TYPE[slot], "count_type": "string", "count": "bigint"}
            tables.append(Table(counts_name(grain), columns, (slot,), ("count_type",), COUNTS_TTL[grain], (slot, "count_type")))
    # A sketch of each hour's topics: those of several hours merge without the topics.
    columns = {"hourslot": "int", "topics": "binary"}
    tables.append(Table(sketches_name("hour"), columns, ("hourslot",), (), COUNTS_TTL["hour"], ("hourslot",)))
    for level, keys in LEVEL_KEYS.items():
        live = ("minuteslot", "batch")
        tables.append(Table(
            live_locations_name(level),
            {"secslot": "bigint", **_geo(level), "time_ms": "bigint", "lat": "float", "long": "float"},
            live, ("secslot", *keys), LIVE_LOCATION_TTL[level], LIVE_KEY))
        tables.append(Table(
            live_messages_name(level),
            {"secslot": "bigint", **_geo(level), "topic": "string", "user": "string",
             "time_ms": "bigint", "tweet": "string"},
            live, ("secslot", *keys, "topic"), LIVE_MESSAGE_TTL[level], LIVE_KEY, ("topic",)))
    for level in ("country", "city"):
        tables.append(Table(
            locations_name(level),
            {**_geo(level), "time_ms": "bigint", "lat": "double", "long": "double"},
            ("dayslot",), (*LEVEL_KEYS[level], "time_ms")))
    return {t.name: t for t in tables}


TABLES = _registry()
