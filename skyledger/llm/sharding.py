"""Balanced label propagation: documents of equal text gather in one shard, and every shard gets the same number of rows.

Law: ``rows``. The row counts of any two shards differ by one at most.

Rows start in shards by hash. Rows of equal text are linked all with all, which is stated through their text. Rows of
one text and one shard are alike, so the label table holds their number: a row for each text that several rows have,
with the rows it has in each shard. In a round every text that is still scattered wishes for the shard that most of
its rows are in, among those with room for all of it; has no shard of its own such room, for another one, the roomier
the likelier. Wishes are counted by shard, size and sub-bucket, and each shard grants them from the largest down
until its quota is full. Texts that were granted theirs have no cut link left and stay. The others vote again in the next
round, whose label table is written anew, until no wish is left or none was granted. Room is what settled texts leave
of a quota: rows without links, and rows of scattered texts, give up their seats for a text that gathers, and take
those it leaves behind. A shard that cannot grant all its wishes fills at least half of its room, so rounds are few.
Texts larger than an eighth of a quota gather first, as long as whole shards are free.

What is left in the end is apart by need: texts larger than a quota, and texts that no shard has room for any more;
there are fewer of either than there are shards. They are cut over as few shards as the room allows. Then rows are
numbered within each shard, whole groups first, then parts, then rows without links. Who is numbered beyond the
shard's quota goes to the shards that have too few, behind their own rows. So the numbers stay gapless, and no whole
group is cut. Which groups fit whole is bin packing, so granting from the largest down need not find the very best choice.

All counts are aggregates that combine in the map tasks, and ranks and numbers are sorted only within sub-buckets. The
driver holds a few numbers for each shard and the texts that come apart (fewer than twice the shards).

Sizes are the UTF-8 bytes of the text plus ``ROW_BYTES``. A null text has no bytes, CRC-32 zero and no links;
empty texts are equal to each other. Rows repeated in full are counted first and are nodes of their own (copy 0, 1, ...),
so they spread over sub-buckets like others; a null id is an id like others. Extra columns are not read. An empty table
gives no rows; with fewer rows than shards, some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import table
from skyledger.session import written

SHARDS = 24
ROW_BYTES = 8
BUCKET_ROWS = 20_000
#: Parts of a group are told apart by hash, in steps of so many.
TICKETS = 1 << 20
#: Texts larger than this part of a quota gather first; there are at most so many of them for each shard.
HEAVY = 8
#: Copies of one row that are written out by one task.
COPY_ROWS = 20_000
PIECES = "array<struct<below: long, shard: int>>"


def longs(xs: list[int]) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in xs or [0]])


def unfolded(rows: DataFrame) -> DataFrame:
    """Each row (..., copies) as often as it says, with ``copy`` from 0; rows of very many copies are dealt to several tasks."""
    few = rows.where(F.col("copies") <= COPY_ROWS).withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    many = rows.where(F.col("copies") > COPY_ROWS).withColumn("from", F.explode(F.expr(f"sequence(0L, copies - 1, {COPY_ROWS}L)")))
    many = many.repartition("doc_id", "text_key", "from")
    many = many.withColumn("copy", F.explode(F.expr(f"sequence(from, least(from + {COPY_ROWS}L, copies) - 1)")))
    return few.drop("copies").unionByName(many.drop("copies", "from"))


def label_table(nodes: DataFrame, shards: int) -> DataFrame:
    """(text_key, n, held) of every text that several of the nodes (mark, text_key) have: its rows, in all and by shard."""
    keyed = nodes.where("text_key is not null").select("text_key", F.pmod("mark", shards).cast("int").alias("shard"))
    counts = keyed.groupBy("text_key", "shard").agg(F.count(F.lit(1)).alias("k"))
    # At most one entry for each shard.
    held = F.sort_array(F.collect_list(F.struct("k", "shard"))).alias("held")
    return counts.groupBy("text_key").agg(F.sum("k").alias("n"), held).where("n > 1")


def wishes(scattered: DataFrame, room: list[int], turn: int) -> DataFrame:
    """The labels (text_key, n, held) with ``target``: the shard a text wishes to gather in, null if none has room for it."""
    rooms = longs(room)
    has_room = lambda shard: F.element_at(rooms, shard + 1) >= F.col("n")
    near = F.array_max(F.transform(F.filter("held", lambda h: has_room(h["shard"])), lambda h: F.struct(h["k"], F.xxhash64("text_key", h["shard"]), h["shard"].alias("shard"))))
    ticket = lambda shard: F.pmod(F.xxhash64("text_key", shard, F.lit(turn)), F.lit(TICKETS)) * F.element_at(rooms, shard + 1)
    every = F.sequence(F.lit(0), F.lit(len(room) - 1))
    far = F.array_max(F.transform(F.filter(every, has_room), lambda shard: F.struct(ticket(shard), shard.alias("shard"))))
    return scattered.withColumn("target", F.coalesce(near["shard"], far["shard"]).cast("int"))


def gather(labels: DataFrame, room: list[int], turn: int) -> DataFrame:
    """One round: the labels with ``shard``, where a text gathers now, or null if its wish was not granted."""
    buckets = max(1, labels.count() // (len(room) * BUCKET_ROWS))
    asked = wishes(labels, room, turn).withColumn("bucket", F.pmod(F.xxhash64("text_key"), buckets).cast("int"))
    counts = asked.where("target is not null").groupBy("target", "n", "bucket").agg(F.count(F.lit(1)).alias("groups"))
    order = Window.partitionBy("target").orderBy(F.col("n").desc(), "bucket").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("upto", F.sum(F.col("n") * F.col("groups")).over(order))
    over = upto.where(F.col("upto") > F.element_at(longs(room), F.col("target") + 1))
    first = F.min(F.struct((-F.col("n")).alias("less"), "bucket", (F.col("upto") - F.col("n") * F.col("groups")).alias("before")))
    # One row for each shard that cannot grant all: the size and sub-bucket in which its room ends, and the room left there.
    ends = {r.target: r.end for r in over.groupBy("target").agg(first.alias("end")).collect()}
    at = lambda values: F.element_at(longs(values), F.col("target") + 1)
    shards = range(len(room))
    size = at([-ends[s].less if s in ends else 0 for s in shards])
    bucket = at([ends[s].bucket if s in ends else 0 for s in shards])
    left = at([room[s] - ends[s].before if s in ends else 0 for s in shards])
    granted = (F.col("n") > size) | ((F.col("n") == size) & (F.col("bucket") < bucket))
    edge = F.coalesce((F.col("n") == size) & (F.col("bucket") == bucket), F.lit(False))
    rank = F.row_number().over(Window.partitionBy("target").orderBy("text_key"))
    columns = ["text_key", "n", "held", "target"]
    clear = asked.where(~edge).select(*columns, granted.alias("granted"))
    ranked = asked.where(edge).select(*columns, (rank * F.col("n") <= left).alias("granted"))
    return clear.unionByName(ranked).select("text_key", "n", "held", F.when(F.col("granted"), F.col("target")).alias("shard"))


def propagate(labels: DataFrame, room: list[int], name: str) -> tuple[list[DataFrame], DataFrame, list[int]]:
    """Rounds until no wish is left or none was granted: the settled labels (.., shard), the scattered ones, and the room left."""
    room, settled, turn = list(room), [], 0
    while True:
        now = written(gather(labels, room, turn), f"shard-{name}-{turn}")
        taken = {r.shard: r.rows for r in now.groupBy("shard").agg(F.sum("n").alias("rows")).collect()}
        scattered = taken.pop(None, 0)
        labels = now.where("shard is null").drop("shard")
        if taken:
            settled.append(now.where("shard is not null"))
            room = [r - taken.get(s, 0) for s, r in enumerate(room)]
        if not taken or not scattered:
            return settled, labels, room
        turn += 1


def cut(n: int, room: list[int]) -> list[tuple[int, int]]:
    """Pieces of a text of ``n`` rows over the roomiest shards, whose room they take.

    A piece (below, shard) takes the rows whose ticket is below that number and that no piece before it took.
    """
    pieces, placed = [], 0
    while placed < n:
        there = max(range(len(room)), key=lambda s: (room[s], -s))
        part = min(room[there], n - placed)
        room[there] -= part
        placed += part
        pieces.append((TICKETS * placed // n, there))
    return pieces


def apart(labels: DataFrame, room: list[int]) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """Pieces of texts that fit into no shard: fewer than there are shards, as together they would fit."""
    return [(bytes(r.text_key), cut(r.n, room)) for r in labels.select("text_key", "n").orderBy(F.desc("n"), "text_key").collect()]


def place(labels: DataFrame, quotas: list[int]) -> DataFrame:
    """(text_key, pieces) of the texts of a label table: one piece for a text that gathers in one shard."""
    room, most = list(quotas), max(quotas)
    parted = apart(labels.where(F.col("n") > most), room)
    heavy = F.col("n") > most // HEAVY
    settled, left, room = propagate(labels.where(heavy & (F.col("n") <= most)), room, "heavy")
    more, last, room = propagate(labels.where(~heavy), room, "label")
    parted += apart(left.unionByName(last), room)
    places = labels.sparkSession.createDataFrame(parted, f"text_key binary, pieces {PIECES}")
    for part in settled + more:
        whole = F.array(F.struct(F.lit(TICKETS).cast("long").alias("below"), F.col("shard").cast("int").alias("shard")))
        places = places.unionByName(part.select("text_key", whole.alias("pieces")))
    return places


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def number(placed: DataFrame, shards: int) -> DataFrame:
    """Replace ``shard`` of (node, mark, shard, linked, ...) by one within the quotas, and add ``slot``."""
    total = placed.count()
    buckets = max(1, total // (shards * BUCKET_ROWS))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("mark", F.lit(99)), buckets).cast("int"))
    key = ["shard", "linked", "bucket"]
    # One row for each shard and bucket; a bucket has about BUCKET_ROWS rows of the shard, so these are few.
    counts = written(placed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    order = Window.partitionBy("shard").orderBy(F.col("linked").desc(), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*key, F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    turn = F.row_number().over(Window.partitionBy(*key).orderBy("mark"))
    numbered = placed.join(starts, key).withColumn("slot", F.col("before") + turn - 1)

    # ``shards`` numbers: what each shard has, may have, and gives or takes.
    have = dict.fromkeys(range(shards), 0) | {r.shard: r.n for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    quota = quotas(total, shards)
    given, gives, takers, begins, firsts = 0, [], [], [], []
    for s in range(shards):
        gives.append(given)
        given += max(0, have[s] - quota[s])
    taken = 0
    for s in range(shards):
        if have[s] < quota[s]:
            takers.append(s)
            begins.append(taken)
            firsts.append(have[s])
            taken += quota[s] - have[s]
    over = F.col("slot") >= F.element_at(longs([quota[s] for s in range(shards)]), F.col("shard") + 1)
    nth = F.element_at(longs(gives), F.col("shard") + 1) + F.col("slot") - F.element_at(longs([quota[s] for s in range(shards)]), F.col("shard") + 1)
    numbered = numbered.withColumn("nth", F.when(over, nth))
    taker = F.size(F.filter(longs(begins), lambda b: b <= F.col("nth")))
    numbered = numbered.withColumn("taker", F.when(over, taker).otherwise(0))
    moves, at = F.col("taker") > 0, F.greatest("taker", F.lit(1))
    return numbered.select(
        *[c for c in placed.columns if c not in ("shard", "slot", "bucket")],
        F.when(moves, F.element_at(longs(takers), at)).otherwise(F.col("shard")).cast("int").alias("shard"),
        F.when(moves, F.element_at(longs(firsts), at) + F.col("nth") - F.element_at(longs(begins), at)).otherwise(F.col("slot")).alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row, equal texts together where the quotas allow."""
    key = F.unhex(F.sha2("text", 256))
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        key.alias("text_key"),
    )
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    nodes = written(unfolded(copies).withColumn("mark", F.xxhash64("doc_id", "text_key", "copy")).drop("copy"), "shard-nodes")
    total = nodes.count()
    # Written, so that the joins read both sides anew and can broadcast the one or split a hot group of the other.
    labels = written(label_table(nodes, shards), "shard-labels")
    places = written(place(labels, quotas(total, shards)), "shard-places")
    linked = nodes.where("text_key is not null").join(places, "text_key", "left")
    placed = linked.unionByName(nodes.where("text_key is null"), allowMissingColumns=True)
    ticket = F.pmod(F.shiftright(F.xxhash64("mark", F.lit(7)), 8), TICKETS)
    shard = F.filter("pieces", lambda p: ticket < p["below"])[0]["shard"]
    whole = F.when(F.size("pieces") == 1, 2).when(F.size("pieces") > 1, 1).otherwise(0)
    placed = placed.select("doc_id", "size", "text_crc32", "mark", whole.alias("linked"), F.coalesce(shard, F.pmod("mark", shards).cast("int")).alias("shard"))
    return number(written(placed, "shard-placed"), shards).select("doc_id", "size", "text_crc32", "shard", "slot")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
