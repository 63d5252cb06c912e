"""DuckDB SQL forms of the fixture views (used by the oracle statements).

They mirror ``scorecast.sources.views`` column for column.
"""

HELPFULNESS = """helpfulness AS (
  SELECT o_orderkey AS Id, o_custkey AS UserId,
         epoch_us(o_orderdate) // 1000000 AS Time,
         CAST(coalesce(li.num, 0) AS INTEGER) AS HelpfulnessNumerator,
         CAST(coalesce(li.den, 0) AS INTEGER) AS HelpfulnessDenominator
  FROM orders LEFT JOIN (
    SELECT l_orderkey, count(*) AS den,
           sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS num
    FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o_orderkey)"""

SHIPMENTS = """shipments AS (
  SELECT epoch_us(l_shipdate) // 1000000 AS Time, l_suppkey AS UserId,
         CAST(l_quantity AS BIGINT) AS Quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS PriceCents
  FROM lineitem)"""

REVIEWS = """reviews AS (
  SELECT doc_id AS Id, split_part(text, chr(10), 1) AS Summary, text AS Text
  FROM documents)"""

LABELLED = """labelled AS (
  SELECT doc_id AS Id, split_part(text, chr(10), 1) AS Summary, text AS Text,
         quality AS Score
  FROM documents JOIN labels USING (doc_id))"""

ACTIVITY = """activity AS (
  SELECT event_id AS Id, user_id AS UserId, epoch_us(ts) // 1000000 AS Time, ts,
         event_type AS EventType, value AS Value
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
