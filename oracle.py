"""The SQL each query is compared with: plain statements over the same Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

SIDES = """
ev AS (SELECT *, strftime(ts, '%Y%m%d') AS shard FROM events),
src AS (
  SELECT event_id, ts, user_id, event_type, value, props, shard,
         CASE WHEN event_type = 'purchase' AND shard IN ('20240130', '20240128', '20240125')
              THEN ts + INTERVAL 1 DAY ELSE ts END AS modified
  FROM ev WHERE shard <> '20240126'),
tgt AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_type = 'purchase' AND shard IN ('20240130', '20240128', '20240125')
              THEN -1.0 ELSE value END AS value,
         CASE WHEN shard <> '20240128' THEN props END AS props,
         shard, ts AS modified
  FROM ev
  WHERE shard <> '20240127'
    AND NOT (event_type = 'signup' AND shard IN ('20240130', '20240128')))"""

COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props", "shard", "modified"]
TYPES = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
    "value": "double", "props": "string", "modified": "timestamp_ntz",
}

DAYS = """
due AS (
  SELECT strftime(DATE '2024-01-31' - CAST(o AS INTEGER), '%Y%m%d') AS shard, CAST(o AS INTEGER) AS "offset"
  FROM range(1, 8) r(o)),
sp AS (SELECT shard, count(*) AS source_rows, max(modified) AS source_modified, 1 AS sn FROM src GROUP BY shard),
tp AS (SELECT shard, count(*) AS target_rows, max(modified) AS target_modified, CASE WHEN shard = '20240128' THEN 0 ELSE 1 END AS tn FROM tgt GROUP BY shard),
days AS (
  SELECT due.shard, due."offset", source_rows, target_rows, source_modified, target_modified,
         (sn > 0) <> (tn > 0) AS schema_changed
  FROM due LEFT JOIN sp ON sp.shard = due.shard LEFT JOIN tp ON tp.shard = due.shard)"""

GATED = "target_rows IS NOT NULL AND (source_modified IS NULL OR source_modified <= target_modified)"
NEWER = "target_modified IS NULL OR source_modified > target_modified"

CHAINS = {
    "incremental": "ELSE 'merge'",
    "modified": f"WHEN \"offset\" = 1 THEN 'merge' WHEN {GATED} THEN 'skipped' ELSE 'merge'",
    "d1_replace": f"WHEN \"offset\" = 1 THEN 'direct_transfer' WHEN {GATED} THEN 'skipped' ELSE 'merge'",
    "rowcount": "WHEN source_rows = target_rows THEN 'skipped' "
                "WHEN \"offset\" = 1 THEN 'direct_transfer' ELSE 'merge'",
    "both": "WHEN source_modified <= target_modified THEN 'skipped' "
            "WHEN source_rows = target_rows THEN 'skipped' "
            "WHEN \"offset\" = 1 THEN 'direct_transfer' ELSE 'merge'",
    "hybrid": "WHEN \"offset\" = 1 THEN 'direct_transfer' WHEN target_rows IS NULL THEN 'backfill_copy' "
              "WHEN source_modified <= target_modified THEN 'skipped' ELSE 'merge'",
    "replicate": "WHEN target_rows IS NULL OR \"offset\" = 1 THEN 'sync_done' "
                 f"WHEN schema_changed THEN 'schema_change' WHEN {NEWER} THEN 'data_change' ELSE 'skipped'",
    "replicate_brief": "WHEN target_rows IS NULL OR \"offset\" = 1 THEN 'sync_done' "
                       f"WHEN schema_changed OR {NEWER} THEN 'sync_done' ELSE 'skipped'",
}


def _plan_cte(policy: str) -> str:
    schema = ", schema_changed" if policy.startswith("replicate") else ""
    return (
        f"{SIDES},{DAYS},\nplan AS (SELECT shard, \"offset\", source_rows, target_rows, source_modified, "
        f"target_modified{schema}, CASE WHEN source_rows IS NULL THEN 'missing_source' "
        f"{CHAINS[policy]} END AS action FROM days)"
    )


def _merge(
    keys: Sequence[str], updates: Sequence[str] | None = None, *, t: str = "tgt", s: str = "src",
    t_columns: Sequence[str] = COLUMNS, s_columns: Sequence[str] = COLUMNS,
) -> str:
    """The merged table: target rows updated from their match, then unmatched source rows."""
    updates = [c for c in s_columns if c not in keys] if updates is None else updates
    out = [*t_columns, *[c for c in s_columns if c not in t_columns]]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)

    def kept(c: str) -> str:
        old = f"t.{c}" if c in t_columns else "NULL"
        return f"CASE WHEN s.hit THEN s.{c} ELSE {old} END AS {c}" if c in updates else f"{old} AS {c}"

    stay = ", ".join(kept(c) for c in out)
    new = ", ".join(f"s.{c}" if c in s_columns else f"NULL AS {c}" for c in out)
    return (
        f"SELECT {stay} FROM {t} t LEFT JOIN (SELECT *, TRUE AS hit FROM {s}) s ON {on}\n"
        f"UNION ALL\nSELECT {new} FROM {s} s WHERE NOT EXISTS (SELECT 1 FROM {t} t WHERE {on})"
    )


LISTED = ", ".join(COLUMNS)
LATEST = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY shard, user_id, event_type "
    "ORDER BY ts DESC, event_id DESC) AS rn FROM src) r WHERE rn = 1"
)
STAGED = """staged AS (
  SELECT src.* FROM src LEFT JOIN (SELECT shard, max(modified) AS hw FROM tgt GROUP BY shard) h
    ON src.shard = h.shard
  WHERE modified > coalesce(hw, TIMESTAMP '1970-01-01 00:00:00'))"""
UPDATABLE = ["ts", "user_id", "event_type", "value", "props"]

REPORT_BUCKETS = ("direct_transfer", "backfill_copy", "merge", "skipped")


def _with(body: str, extra: str = "") -> str:
    return f"WITH {SIDES}{',' + extra if extra else ''}\n{body}"


def _days_of(policy: str, *actions: str) -> str:
    listed = ", ".join(f"'{a}'" for a in actions)
    return f"SELECT shard FROM plan WHERE action IN ({listed})"


def _declared(side: str, table: str) -> str:
    """The columns of each day there is; the target's drifted day was written without props."""
    names = [c for c in COLUMNS if c != "shard"]
    rows = ", ".join(f"({i}, '{c}', '{TYPES[c]}')" for i, c in enumerate(names, start=1))
    lacking = "WHERE NOT (shard = '20240128' AND name = 'props') " if table == "tgt" else ""
    return (
        f"SELECT '{side}' AS side, shard, (row_number() OVER (PARTITION BY shard ORDER BY p))::INTEGER AS pos, name, type "
        f"FROM (SELECT DISTINCT shard FROM {table}) d, (VALUES {rows}) v(p, name, type) {lacking}"
    )


def _result(policy: str, copied: Sequence[str], merged: Sequence[str]) -> str:
    copies = _days_of(policy, *copied)
    merges = _days_of(policy, *merged) if merged else ""
    parts = [
        f"SELECT {LISTED} FROM tgt WHERE shard NOT IN ({_days_of(policy, *copied, *merged)})",
        f"SELECT {LISTED} FROM src WHERE shard IN ({copies})",
    ]
    extra = ""
    if merged:
        extra = (
            f",\nms AS (SELECT * FROM src WHERE shard IN ({merges})),"
            f"\nmt AS (SELECT * FROM tgt WHERE shard IN ({merges}))"
        )
        parts.append(f"SELECT {LISTED} FROM ({_merge(['shard', 'event_id'], t='mt', s='ms')}) m")
    return f"WITH {_plan_cte(policy)}{extra}\n" + "\nUNION ALL\n".join(parts)


def _hybrid_result() -> str:
    return _result("hybrid", ["direct_transfer", "backfill_copy"], ["merge"])


def _replicate_result() -> str:
    return _result("replicate", ["sync_done", "schema_change", "data_change"], [])


def _event_key_result() -> str:
    """Keys are the hour and the type; of source rows with one key the latest wins in merged days."""
    columns = ["event_time", "event_name", "value", "modified", "shard"]
    shown = "date_trunc('hour', ts) AS event_time, event_type AS event_name, value, modified, shard"
    merges, copies = _days_of("hybrid", "merge"), _days_of("hybrid", "direct_transfer", "backfill_copy")
    listed = ", ".join(columns)
    return (
        f"WITH {_plan_cte('hybrid')},\nes AS (SELECT {shown} FROM src),\net AS (SELECT {shown} FROM tgt),"
        "\nms AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY shard, event_time, event_name "
        f"ORDER BY modified DESC, value DESC) AS rn FROM es WHERE shard IN ({merges})) r WHERE rn = 1),"
        f"\nmt AS (SELECT * FROM et WHERE shard IN ({merges}))"
        f"\nSELECT {listed} FROM et WHERE shard NOT IN ({copies}) AND shard NOT IN ({merges})"
        f"\nUNION ALL SELECT {listed} FROM es WHERE shard IN ({copies})"
        f"\nUNION ALL SELECT {listed} FROM ("
        + _merge(["shard", "event_time", "event_name"], t="mt", s="ms", t_columns=columns, s_columns=columns) + ") m"
    )


def _composite_result() -> str:
    columns = ["event_id", "user_pseudo_id", "event_timestamp", "event_name", "value", "modified", "shard"]
    shown = "event_id, user_id AS user_pseudo_id, ts AS event_timestamp, event_type AS event_name, value, modified, shard"
    merges, copies = _days_of("hybrid", "merge"), _days_of("hybrid", "direct_transfer", "backfill_copy")
    listed = ", ".join(columns)
    return (
        f"WITH {_plan_cte('hybrid')},\nes AS (SELECT {shown} FROM src),\net AS (SELECT {shown} FROM tgt),"
        f"\nms AS (SELECT * FROM es WHERE shard IN ({merges})),\nmt AS (SELECT * FROM et WHERE shard IN ({merges}))"
        f"\nSELECT {listed} FROM et WHERE shard NOT IN ({copies}) AND shard NOT IN ({merges})"
        f"\nUNION ALL SELECT {listed} FROM es WHERE shard IN ({copies})"
        f"\nUNION ALL SELECT {listed} FROM ("
        + _merge(["shard", "user_pseudo_id", "event_timestamp", "event_name"], t="mt", s="ms", t_columns=columns, s_columns=columns)
        + ") m"
    )


def _buckets(policy: str = "hybrid", buckets: Sequence[str] = REPORT_BUCKETS) -> str:
    lines = [
        f"SELECT '{b}' AS bucket, count(*) FILTER (WHERE b = '{b}') AS days, "
        f"coalesce(string_agg(shard, ', ' ORDER BY shard) FILTER (WHERE b = '{b}'), 'None') AS shards FROM binned"
        for b in buckets
    ]
    names = ", ".join(f"'{b}'" for b in buckets)
    binned = f"binned AS (SELECT shard, CASE WHEN action IN ({names}) THEN action ELSE 'skipped' END AS b FROM plan)"
    return f"WITH {_plan_cte(policy)},\n{binned}\n" + "\nUNION ALL ".join(lines)


def statements() -> dict[str, str]:
    hybrid = f"WITH {_plan_cte('hybrid')}\n"
    sql = {
        "shard_scan": f"WITH {SIDES} SELECT * FROM ev WHERE shard = '20240130'",
        "lookback_scan": f"WITH {SIDES} SELECT * FROM ev WHERE shard BETWEEN '20240124' AND '20240130'",
        "shard_name": "SELECT event_id, 'events_' || strftime(ts, '%Y%m%d') AS table_name FROM events",
        "missing_shards": f"WITH {SIDES},{DAYS} SELECT shard, \"offset\" FROM due "
                          "WHERE shard NOT IN (SELECT shard FROM src)",
        "equi_join": "SELECT o.o_orderkey AS common_id, o.o_custkey, o.o_orderstatus, o.o_totalprice AS price_x, "
                     "o.o_orderdate, o.o_orderpriority, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, "
                     "l.l_extendedprice AS price_y, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, "
                     "l.l_shipdate FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey",
        "shard_counts": _with("SELECT shard, count(*) AS rows FROM src GROUP BY shard"),
        "shard_high_water": _with("SELECT shard, max(modified) AS high_water FROM tgt GROUP BY shard"),
        "schema_rows": _with(f"{_declared('source', 'src')}\nUNION ALL {_declared('target', 'tgt')}"),
        "schema_fingerprint": _with(
            "SELECT side, shard, string_agg(name || ':' || type, '|' ORDER BY pos) AS fingerprint FROM ("
            f"{_declared('source', 'src')}\nUNION ALL {_declared('target', 'tgt')}) r GROUP BY side, shard"
        ),
        "schema_drift": _with(
            "SELECT coalesce(s.shard, t.shard) AS shard, coalesce(s.name, t.name) AS name, s.type AS source_type, "
            "t.type AS target_type, CASE WHEN t.type IS NULL THEN 'added' WHEN s.type IS NULL THEN 'removed' "
            "ELSE 'type_changed' END AS change "
            "FROM sr s FULL JOIN tr t ON s.shard = t.shard AND s.name = t.name "
            "WHERE s.type IS DISTINCT FROM t.type "
            "AND coalesce(s.shard, t.shard) IN (SELECT shard FROM src INTERSECT SELECT shard FROM tgt)",
            f"\nsr AS ({_declared('source', 'src')}),\ntr AS ({_declared('target', 'tgt')})",
        ),
        "report_by_action": hybrid + "SELECT action, count(*) AS days, string_agg(shard, ', ' ORDER BY shard) "
                                     "AS shards FROM plan GROUP BY action",
        "report_buckets": _buckets(),
        "report_transfers": hybrid + "SELECT coalesce(string_agg(shard, ', ' ORDER BY shard) FILTER (WHERE action = "
                                     "'direct_transfer'), 'No transfers') AS transferred, "
                                     "coalesce(string_agg(shard, ', ' ORDER BY shard) FILTER (WHERE action = 'merge'), "
                                     "'No merges') AS merged FROM plan",
        "report_ready": hybrid + "SELECT shard, CASE WHEN source_rows IS NULL THEN 'SKIPPED' ELSE 'READY' END AS status, "
                                 "CASE WHEN action IN ('skipped', 'missing_source') THEN CASE WHEN \"offset\" = 1 "
                                 "THEN 'SKIPPED (no changes or source missing)' ELSE 'SKIPPED (no changes)' END "
                                 "WHEN \"offset\" = 1 THEN 'MERGED (Direct Transfer)' "
                                 "ELSE 'MERGED (Conditional Update)' END AS result FROM plan",
        "dedupe_latest": _with(LATEST),
        "merge_by_id": _with(_merge(["shard", "event_id"])),
        "merge_composite": _with(_merge(["shard", "user_id", "ts", "event_type"])),
        "merge_keep_modified": _with(_merge(["shard", "event_id"], UPDATABLE)),
        "merge_dedup": _with(_merge(["shard", "user_id", "event_type"], s="one"), f"\none AS ({LATEST})"),
        "merge_fingerprint": _with(
            f"SELECT {LISTED} FROM tgt UNION ALL SELECT {LISTED} FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE "
            + " AND ".join(f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in COLUMNS if c != "modified") + ")"
        ),
        "incremental_rows": _with("SELECT * FROM staged", f"\n{STAGED}"),
        "merge_incremental": _with(_merge(["shard", "event_id"], UPDATABLE, s="staged"), f"\n{STAGED}"),
        "evolve_schema": _with(
            _merge(
                ["shard", "event_id"], t="drifted",
                t_columns=["event_id", "ts", "user_id", "event_type", "value", "shard", "modified", "loaded_from"],
            ),
            "\ndrifted AS (SELECT * EXCLUDE (props), 'events_' || shard AS loaded_from FROM tgt)",
        ),
        "empty_clone": _with("SELECT * FROM src"),
        "replace_shard": _with(
            f"SELECT {LISTED} FROM tgt WHERE shard <> '20240130' "
            f"UNION ALL SELECT {LISTED} FROM src WHERE shard = '20240130'"
        ),
        "replace_narrows": "SELECT r.*, CASE WHEN shard = '20240129' THEN 'n' || CAST(event_id AS VARCHAR) END AS note FROM ("
                           + _result("d1_replace", ["direct_transfer"], ["merge"]) + ") r",
        "backfill_copy": _with(
            f"SELECT {LISTED} FROM tgt UNION ALL SELECT {LISTED} FROM src WHERE shard NOT IN (SELECT shard FROM tgt) "
            "AND shard BETWEEN '20240124' AND '20240130'"
        ),
        "hybrid_result": _hybrid_result(),
        "replicate_result": _replicate_result(),
        "incremental_result": _with(
            f"SELECT {LISTED} FROM tgt WHERE shard < '20240124' UNION ALL SELECT {LISTED} FROM ("
            + _merge(["shard", "event_id"], UPDATABLE, t="wt", s="ws") + ") m "
            f"UNION ALL SELECT {LISTED} FROM tgt WHERE shard = '20240126'",
            f"\n{STAGED},\nws AS (SELECT * FROM staged WHERE shard >= '20240124'),"
            "\nwt AS (SELECT * FROM tgt WHERE shard >= '20240124' AND shard <> '20240126')",
        ),
        "hybrid_sync_table": _hybrid_result(),
        "replicate_sync_table": _replicate_result(),
        "hybrid_sync_report": hybrid + "SELECT p.shard, action, CASE WHEN action IN ('direct_transfer', "
                                       "'backfill_copy', 'merge') THEN n END AS written_rows FROM plan p LEFT JOIN ("
                                       "SELECT shard, count(DISTINCT event_id) AS n FROM (SELECT shard, event_id FROM src "
                                       "UNION ALL SELECT t.shard, t.event_id FROM tgt t JOIN plan q ON t.shard = q.shard "
                                       "WHERE q.action = 'merge') b GROUP BY shard) c ON c.shard = p.shard",
        "export_projection": "SELECT c_custkey AS id, c_name AS name FROM customer",
        "append_by_name": _with(
            f"SELECT {LISTED} FROM tgt UNION ALL SELECT event_id, ts, NULL, event_type, NULL, NULL, shard, NULL "
            "FROM src"
        ),
        "union_all": _with(f"SELECT {LISTED} FROM src UNION ALL SELECT {LISTED} FROM tgt"),
        "update_all": _with(
            "SELECT * REPLACE ('whole ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS props) FROM tgt"
        ),
        "update_by_subquery": _with(
            "SELECT * REPLACE (CASE WHEN event_id IN (SELECT event_id FROM tgt ORDER BY event_id LIMIT 1) "
            "THEN 'first by id' ELSE props END AS props) FROM tgt"
        ),
        "update_top_k": _with(
            "SELECT * REPLACE (CASE WHEN event_id IN (SELECT event_id FROM tgt ORDER BY event_id LIMIT 3) "
            "THEN 'user ' || CAST(user_id AS VARCHAR) ELSE props END AS props) FROM tgt"
        ),
        "row_fingerprint": _with(
            "SELECT event_id, concat(coalesce(CAST(event_id AS VARCHAR), 'NULL'), coalesce(CAST(user_id AS VARCHAR), "
            "'NULL'), coalesce(event_type, 'NULL'), coalesce(props, 'NULL')) AS row_text FROM tgt"
        ),
        "case_label": "SELECT event_id, event_id % 5 AS event_type_id, CASE event_id % 5 WHEN 0 THEN 'login' "
                      "WHEN 1 THEN 'logout' WHEN 2 THEN 'purchase' WHEN 3 THEN 'click' ELSE 'view' END AS label "
                      "FROM events",
        "timestamp_shift": "SELECT event_id, ts - INTERVAL 4 DAY AS four_days_before, "
                           "ts + to_minutes(event_id % 10) AS minutes_after, "
                           "TIMESTAMP '2024-01-21 12:00:00' AS ten_days_ago FROM events",
        "generate_events": """
WITH g AS (
  SELECT event_id, ts, n, md5(CAST(event_id AS VARCHAR) || ':' || CAST(n AS VARCHAR)) AS h,
         (event_id + n) % 5 AS event_type_id
  FROM events, range(1, 6) r(n))
SELECT h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS id,
       event_type_id,
       CASE event_type_id WHEN 0 THEN 'login' WHEN 1 THEN 'logout' WHEN 2 THEN 'purchase'
            WHEN 3 THEN 'click' ELSE 'view' END AS event_type,
       'Event ' || CAST(n AS VARCHAR) AS description,
       ts + to_minutes(n % 10) AS last_modified
FROM g""",
    }
    for policy in ("modified", "d1_replace", "rowcount", "both"):
        sql[f"{policy}_sync_table"] = _result(policy, ["direct_transfer"], ["merge"])
    sql["incremental_sync_table"] = sql["incremental_result"]
    sql["incremental_first_sync"] = _with(f"SELECT {LISTED} FROM src WHERE shard BETWEEN '20240124' AND '20240130'")
    sql["event_key_sync_table"] = _event_key_result()
    sql["composite_sync_table"] = _composite_result()
    sql["report_replicate"] = _buckets("replicate", ("sync_done", "schema_change", "data_change", "skipped", "missing_source"))
    sql["day_tables_sync"] = f"SELECT * FROM ({_hybrid_result()}) r WHERE shard BETWEEN '20240124' AND '20240130'"
    sql["update_first_ties"] = _with(
        "SELECT * REPLACE (CASE WHEN event_id IN (SELECT event_id FROM tgt ORDER BY user_id, ts, event_id LIMIT 3) "
        "THEN 'tied ' || CAST(event_id AS VARCHAR) ELSE props END AS props) FROM tgt"
    )
    sql["generate_events_facts"] = (
        "SELECT 'Event ' || CAST(n AS VARCHAR) AS description, count(*) AS rows, count(*) AS ids, count(*) AS uuids, "
        "count(*) AS labels, 0::BIGINT AS least_type, 4::BIGINT AS most_type, 0::BIGINT AS no_time "
        "FROM events, range(1, 6) r(n) GROUP BY n"
    )
    # Days are alike if they have the same rows as often, whatever their order.
    listed = ", ".join(c for c in COLUMNS)
    sql["checksum_sync_plan"] = (
        f"WITH {SIDES},{DAYS},\nn1 AS (SELECT {listed}, count(*) AS n FROM src GROUP BY ALL),"
        f"\nn2 AS (SELECT {listed}, count(*) AS n FROM tgt GROUP BY ALL),"
        "\nchanged AS (SELECT DISTINCT shard FROM ((SELECT * FROM n1 EXCEPT SELECT * FROM n2) UNION ALL "
        "(SELECT * FROM n2 EXCEPT SELECT * FROM n1)) x)"
        "\nSELECT shard, \"offset\", source_rows, target_rows, source_modified, target_modified, "
        "CASE WHEN source_rows IS NULL THEN 'missing_source' WHEN shard NOT IN (SELECT shard FROM changed) THEN 'skipped' "
        "WHEN \"offset\" = 1 THEN 'direct_transfer' WHEN target_rows IS NULL THEN 'backfill_copy' ELSE 'merge' END AS action FROM days"
    )
    sql["sync_plan_file_times"] = (
        f"WITH {SIDES},{DAYS}\nSELECT shard, \"offset\", source_rows, target_rows, CASE WHEN source_rows IS NULL THEN "
        "'missing_source' WHEN \"offset\" = 1 THEN 'direct_transfer' WHEN target_rows IS NULL THEN 'backfill_copy' "
        "ELSE 'merge' END AS action FROM days"
    )
    sql["partitions_sync"] = _hybrid_result()
    sql["catalog_evolve"] = _with("SELECT * REPLACE (CAST(NULL AS VARCHAR) AS props) FROM tgt")
    # The newest rows of both sides are alike, so only the numbers of rows tell.
    sql["late_rows"] = (
        f"WITH {SIDES.replace('+ INTERVAL 1 DAY', '')},{DAYS}\nSELECT shard, \"offset\", source_rows, target_rows, "
        "source_modified, target_modified, CASE WHEN source_rows IS NULL THEN 'missing_source' "
        "WHEN \"offset\" = 1 THEN 'merge' WHEN target_rows IS NOT NULL AND source_rows <= target_rows "
        "AND source_modified <= target_modified THEN 'skipped' ELSE 'merge' END AS action FROM days"
    )
    sql["merge_bucketed"] = sql["merge_by_id"]
    # Which fields differ is known; the days are those both sides have.
    lacking = [
        ("about.what.value", "double"), ("about.props", "string"), ("steps.element.value", "double"), ("facts.value.value", "double"),
    ]
    rows = [("false", p, f"'{t}'", "NULL", "added") for p, t in lacking]
    rows += [("true", p, f"'{t}'", "NULL", "added") for p, t in (("about.what", "struct<kind:string,value:double>"), *lacking[1:])]
    rows += [(older, "steps.element.n", "'int'", "'bigint'", "type_changed") for older in ("false", "true")]
    values = ", ".join(f"({older}, '{p}', {a}, {b}, '{c}')" for older, p, a, b, c in rows)
    sql["nested_drift"] = _with(
        "SELECT d.shard, path, source_type, CAST(target_type AS VARCHAR) AS target_type, change FROM (SELECT DISTINCT shard FROM src "
        "INTERSECT SELECT DISTINCT shard FROM tgt) d "
        f"JOIN (VALUES {values}) c(older, path, source_type, target_type, change) ON c.older = (d.shard = '20240128')"
    )
    sql["nested_evolve"] = _with(
        "SELECT event_id, shard, user_id, event_type AS kind, value AS what_value, props, 1::BIGINT AS n, value AS step_value, "
        "CAST(user_id AS VARCHAR) AS who, value AS fact_value FROM src UNION ALL "
        "SELECT event_id, shard, user_id, event_type, NULL, NULL, 1, NULL, CAST(user_id AS VARCHAR), NULL FROM tgt "
        "WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.shard = tgt.shard AND s.event_id = tgt.event_id)"
    )
    sql["merge_partial_key"] = sql["merge_composite"]
    for policy in CHAINS:
        sql[f"sync_plan_{policy}"] = f"WITH {_plan_cte(policy)}\nSELECT * FROM plan"
    return sql
