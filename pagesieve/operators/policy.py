"""Field gate, robots rules and the authorization that follows from both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, urls
from ..functions.text import list_repr, split_key, strip

LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\x{2028}\x{2029}]"


# --- requested fields ---------------------------------------------------------
def normalised(fields: Column) -> Column:
    return F.transform(fields, lambda f: F.lower(strip(f)))


def sensitive(fields: Column) -> Column:
    """Requested names on the block list, in request order."""
    return F.filter(normalised(fields), lambda f: f.isin(fixed.SENSITIVE_FIELDS))


def field_gate(jobs: DataFrame) -> DataFrame:
    """Add requested, blocked_fields, risk_level, risk_decision, risk_reason.

    The block list is 22 literals inside the expression: no join, no shuffle.
    """
    blocked = F.size("blocked_fields") > 0
    return (
        jobs.withColumn("requested", normalised(F.col("fields")))
        .withColumn("blocked_fields", sensitive(F.col("fields")))
        .withColumn("risk_level", F.when(blocked, "high").otherwise("low"))
        .withColumn("risk_decision", F.when(blocked, "blocked").otherwise("permitted"))
        .withColumn(
            "risk_reason",
            F.when(
                blocked,
                F.concat(
                    F.lit("Requested fields contain sensitive data categories: "),
                    list_repr(F.col("blocked_fields")),
                    F.lit(". Collection of these fields is not permitted."),
                ),
            ).otherwise(
                F.concat(
                    F.lit("All requested fields ("),
                    list_repr(F.col("requested")),
                    F.lit(") passed sensitive-field check. Risk level: low."),
                )
            ),
        )
    )


# --- robots files ---------------------------------------------------------------
def fetch_outcome(files: DataFrame) -> DataFrame:
    """Add ``outcome``: warning, disallow_all, allow_all, unread or parse."""
    return files.withColumn(
        "outcome",
        F.when(F.col("error").isNotNull(), "warning")
        .when(F.col("status").isin(401, 403), "disallow_all")
        .when(F.col("status").between(400, 499), "allow_all")
        .when(F.col("status") >= 500, "unread")
        .otherwise("parse"),
    )


def one_per_origin(files: DataFrame) -> DataFrame:
    """The latest captured robots file of each origin (by fetched_at, if there is one; then by content)."""
    content = ["status", "error", "body"]
    order = [c for c in ("fetched_at",) if c in files.columns] + content
    last = F.max_by(F.struct(*content), F.struct(*order))
    return files.groupBy("origin").agg(last.alias("f")).select("origin", "f.*")


def robots_groups(files: DataFrame) -> DataFrame:
    """(origin, group_no, agents, rules[allow, path]) of every parsed file, one file per origin.

    The windows run over the lines of one robots body, which arrived as one row.
    """
    clean = strip(F.regexp_replace("line", r"(?s)#.*$", ""))
    by_line = Window.partitionBy("origin").orderBy("line_no")
    so_far = by_line.rowsBetween(Window.unboundedPreceding, 0)
    in_group = (
        Window.partitionBy("origin", "group_no")
        .orderBy("line_no")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    rule_keys = ["allow", "disallow", "crawl-delay", "request-rate"]
    events = (
        fetch_outcome(files)
        .where("outcome = 'parse'")
        .select("origin", F.posexplode(F.split("body", LINE_BREAK)).alias("line_no", "line"))
        .withColumn("clean", clean)
        .withColumn("key", F.lower(strip(F.regexp_extract("clean", r"^([^:]*):", 1))))
        .withColumn("value", urls.unquote(strip(F.regexp_extract("clean", r"(?s)^[^:]*:(.*)$", 1))))
        .withColumn(
            "event",
            F.when(F.col("line") == "", "empty")
            .when(F.col("key") == "user-agent", "agent")
            .when(F.col("key").isin(rule_keys), "rule"),
        )
        .where(F.col("event").isNotNull())
        .withColumn("before", F.coalesce(F.lag("event").over(by_line), F.lit("")))
        .withColumn("opens", ((F.col("event") == "agent") & (F.col("before") != "agent")).cast("int"))
        .withColumn("group_no", F.sum("opens").over(so_far))
        .withColumn("ends", F.sum((F.col("event") == "empty").cast("int")).over(in_group))
        .where("group_no > 0 and ends = 0")
    )
    is_path = F.col("key").isin("allow", "disallow")
    rule = F.struct(
        F.col("line_no"),
        ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"),
        urls.quote(F.regexp_replace("value", r"\??#?$", "")).alias("path"),
    )
    agent = F.struct(F.col("line_no"), F.col("value"))
    return (
        events.groupBy("origin", "group_no")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("event") == "agent", agent))).alias("agents"),
            F.sort_array(F.collect_list(F.when(is_path, rule))).alias("rules"),
            F.max(F.col("event") == "rule").alias("complete"),
        )
        .where("complete")
        .select(
            "origin",
            "group_no",
            F.transform("agents", lambda a: a["value"]).alias("agents"),
            F.transform("rules", lambda r: F.struct(r["allow"], r["path"])).alias("rules"),
        )
    )


def robots_rule_table(files: DataFrame) -> DataFrame:
    """One row per rule; a group without path rules keeps one row of nulls."""
    return robots_groups(one_per_origin(files)).select(
        "origin", "group_no", "agents", F.posexplode_outer("rules").alias("rule_no", "rule")
    ).select("origin", "group_no", "agents", "rule_no", "rule.allow", "rule.path")


def site_policy(files: DataFrame, user_agent: str = fixed.USER_AGENT) -> DataFrame:
    """One row per origin: fetch outcome and the rules that apply to our agent."""
    files = one_per_origin(files)
    token = user_agent.split("/")[0].lower()
    star = F.array_contains("agents", "*")
    named = F.exists("agents", lambda a: F.contains(F.lit(token), F.lower(a)))
    chosen = (
        robots_groups(files)
        .where(star | named)
        .groupBy("origin")
        .agg(F.min_by("rules", F.struct(star, F.col("group_no"))).alias("rules"))
    )
    return fetch_outcome(files).select("origin", "outcome", "error").join(chosen, "origin", "left")


def robots_decision(jobs: DataFrame, files: DataFrame, user_agent: str = fixed.USER_AGENT) -> DataFrame:
    """Add robots_decision (permitted, blocked, warning) and robots_reason.

    ``jobs`` should be thin (keys and URL): it is the side that gets shuffled.
    Nothing is hinted; the planner broadcasts the site table only under its
    measured size limit, and beyond it adaptive execution splits hot origins.
    """
    policy = site_policy(files, user_agent).select(
        split_key(F.col("origin")).alias("_site"), "outcome", F.col("error").alias("robots_error"), "rules"
    )
    rest = F.regexp_replace(
        urls.unquote(F.col("url")), r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?", ""
    )
    asked = urls.quote(F.regexp_replace(rest, r"\??#?$", ""))
    first_rule = F.try_element_at(
        F.filter("rules", lambda r: F.startswith(F.col("asked"), r["path"])), F.lit(1)
    )
    robots_url = F.concat(F.col("origin"), F.lit("/robots.txt"))
    site_path = urls.path(F.col("url"))
    shown = F.when(site_path == "", "/").otherwise(site_path)
    return (
        jobs.withColumn("origin", urls.origin(F.col("url")))
        .withColumn("asked", F.when(asked == "", "/").otherwise(asked))
        .withColumn("_site", split_key(F.col("origin")))
        .join(policy, "_site", "left")
        .withColumn(
            "robots_decision",
            F.when(F.col("outcome").isNull() | (F.col("outcome") == "warning"), "warning")
            .when(F.col("outcome").isin("disallow_all", "unread"), "blocked")
            .when(F.col("outcome") == "allow_all", "permitted")
            .when(F.coalesce(first_rule["allow"], F.lit(True)), "permitted")
            .otherwise("blocked"),
        )
        .withColumn(
            "robots_reason",
            F.when(
                F.col("robots_decision") == "warning",
                F.concat(
                    F.lit("Could not read robots.txt at "), robots_url, F.lit(": "),
                    F.coalesce("robots_error", F.lit("not captured")),
                    F.lit(". Proceeding with caution."),
                ),
            )
            .when(
                F.col("robots_decision") == "permitted",
                F.concat(
                    F.lit("robots.txt at "), robots_url,
                    F.lit(f" permits '{user_agent}' to access path '"), shown, F.lit("'."),
                ),
            )
            .otherwise(
                F.concat(
                    F.lit("robots.txt at "), robots_url,
                    F.lit(f" disallows '{user_agent}' from accessing path '"), shown,
                    F.lit("'. Job blocked."),
                )
            ),
        )
        .drop("rules", "robots_error", "_site")
    )


# --- both together ----------------------------------------------------------------
def authorization_gate(df: DataFrame) -> DataFrame:
    """First blocker wins. Adds blocked_by, allowed, authorization_status.

    Needs risk_level, robots_decision, status, error. A network error clears
    ``allowed`` but leaves the robots verdict as status.
    """
    risk = F.col("risk_level") == "high"
    robots = F.col("robots_decision") == "blocked"
    status = F.col("error").isNull() & F.col("status").isin(fixed.BLOCKED_STATUS)
    return (
        df.withColumn(
            "blocked_by",
            F.when(risk, "risk_engine")
            .when(robots, "robots_checker")
            .when(F.col("error").isNotNull() | F.coalesce(status, F.lit(False)), "source_profiler"),
        )
        .withColumn("allowed", F.col("blocked_by").isNull())
        .withColumn(
            "authorization_status",
            F.when(risk | robots | F.coalesce(status, F.lit(False)), "blocked").otherwise(
                F.col("robots_decision")
            ),
        )
    )
