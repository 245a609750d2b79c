"""Webhook-shaped DataFrames derived from a TPC-H-like set of tables.

The driver tables hold no webhooks. Every function here maps their rows to
webhook events (or to one of the state tables) by integer and date arithmetic
alone, so that SQL on the base tables can state the expected results without
going through JSON. Remainders decide what a row looks like and which state table knows it
(which runs already have an artifact, which pull requests a comment). Each set
is a lazy DataFrame that grows with its table; nothing is collected or sampled.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devmetrics.functions.signature import webhook_signature
from devmetrics.schemas import OPTIMIZED_EVENTS

WEBHOOK_SECRET = b"correct-horse-battery-staple"
RECEIVED_BASE = "2024-01-01"


def login(number: Column) -> Column:
    """A user name in mixed case, 97 of them."""
    return F.concat(F.lit("User"), (number % 97).cast("string"))


def iso(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def plus(time: Column, number: Column, unit: str) -> Column:
    return time + F.make_dt_interval(**{unit: number.cast("int")})


def text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def obj(**fields: Column) -> Column:
    return F.struct(*(value.alias(name) for name, value in fields.items()))


def null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def as_event(
    df: DataFrame, event: Column | str, delivery_id: Column, received: Column, payload: Column,
    **identity: Column,
) -> DataFrame:
    """One row per webhook in the columns of the event table."""
    values = {
        "delivery_id": delivery_id,
        "signature": null(),
        "received": received,
        "event": F.lit(event) if isinstance(event, str) else event,
        "payload": payload,
        **identity,
    }
    return df.select(
        *(
            values.get(f.name, null()).cast(f.dataType).alias(f.name)
            for f in OPTIMIZED_EVENTS.schema
        )
    )


class DerivedEvents:
    """All derived sets over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _table(self, name: str, *times: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.withColumns({t: F.col(t).cast("timestamp") for t in times})

    def _spread(self, df: DataFrame, *keys: str) -> DataFrame:
        """Deal rows out by a hash of their key where the scan has too few tasks: building JSON is most of the work here."""
        tasks = self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, *keys)

    @cached_property
    def lineitem(self) -> DataFrame:
        return self._spread(
            self._table("lineitem", "l_shipdate").select(
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"
            ),
            "l_orderkey", "l_linenumber",
        )

    @cached_property
    def activity(self) -> DataFrame:
        """The driver's event stream."""
        return self._spread(self._table("events", "ts"), "event_id")

    @cached_property
    def orders(self) -> DataFrame:
        """Orders with the organization and repository their customer's nation stands for."""
        nations = (
            self._table("nation")
            .join(self._table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("nk"),
                F.col("r_regionkey").alias("rk"),
                F.lower("n_name").alias("repo"),
                F.lower(F.replace("r_name", F.lit(" "), F.lit("-"))).alias("org"),
            )
        )
        customers = self._table("customer").select(
            F.col("c_custkey").alias("ck"), F.col("c_nationkey").alias("nk")
        )
        orders = self._table("orders", "o_orderdate").select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("ck"),
            F.col("o_orderstatus").alias("st"),
            F.col("o_orderpriority").alias("pri"),
            F.col("o_orderdate").alias("d"),
            F.floor("o_totalprice").alias("tp"),
        )
        return self._spread(orders, "k").join(customers, "ck").join(nations, "nk")

    # -- events -----------------------------------------------------------

    def _identity(self) -> dict[str, Column]:
        return {
            "enterprise_id": F.col("rk"),
            "enterprise_name": self._enterprise(),
            "organization_id": F.col("rk") + 1,
            "organization_name": F.col("org"),
            "repository_id": F.col("nk") + 100,
            "repository_name": text(F.col("org"), "/", F.col("repo")),
        }

    @staticmethod
    def _enterprise() -> Column:
        return F.when(F.col("rk") < 2, text("Google-", F.col("org"))).otherwise(
            text("ent-", F.col("org"))
        )

    @cached_property
    def pull_requests(self) -> DataFrame:
        k, d, org, repo = (F.col(c) for c in ("k", "d", "org", "repo"))
        closed, merged = F.col("st").isin("F", "P"), F.col("st") == "F"
        pull_request = obj(
            id=k + 1_000_000,
            html_url=text("https://github.com/", org, "/", repo, "/pull/", k),
            user=obj(login=login(F.col("ck"))),
            merged=merged,
            additions=F.col("tp") % 1000,
            deletions=F.col("tp") % 300,
            created_at=iso(d - F.expr("INTERVAL 3 DAYS")),
            merged_at=F.when(merged, iso(d)),
            updated_at=iso(d),
            head=obj(ref=text("feature-", k % 50), sha=F.md5(text("h", k))),
        )
        payload = obj(
            action=F.when(closed, F.lit("closed")).otherwise("opened"),
            pull_request=pull_request,
            enterprise=obj(id=F.col("rk"), name=self._enterprise()),
            organization=obj(id=F.col("rk") + 1, login=org),
            repository=obj(
                id=F.col("nk") + 100,
                name=repo,
                full_name=text(org, "/", repo),
                html_url=text("https://github.com/", org, "/", repo),
            ),
            sender=obj(login=login(F.col("ck"))),
        )
        return as_event(
            self.orders, "pull_request", text("pr-", k), plus(d, k % 86400, "secs"),
            F.to_json(payload), **self._identity(),
        )

    def _line_id(self, prefix: str) -> Column:
        parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        return F.concat_ws("-", F.lit(prefix), *(F.col(c).cast("string") for c in parts))

    @cached_property
    def reviews(self) -> DataFrame:
        lines = self.lineitem.filter(F.col("l_linenumber").between(1, 3))
        user = obj(login=login(F.col("l_suppkey")))
        payload = obj(
            action=F.lit("submitted"),
            pull_request=obj(id=F.col("l_orderkey") + 1_000_000),
            review=obj(user=user, updated_at=iso(F.col("l_shipdate")), state=self._review_state()),
            sender=user,
        )
        return as_event(
            lines, "pull_request_review", self._line_id("rv"), F.col("l_shipdate"),
            F.to_json(payload),
        )

    @staticmethod
    def _review_state() -> Column:
        flag = F.col("l_returnflag")
        return F.when(flag == "A", "approved").when(flag == "R", "changes_requested").otherwise(
            "commented"
        )

    @cached_property
    def comments(self) -> DataFrame:
        lines = self.lineitem.filter(F.col("l_linenumber").between(4, 6))
        user = obj(login=login(F.col("l_suppkey")))
        payload = obj(
            action=F.lit("created"),
            pull_request=obj(id=F.col("l_orderkey") + 1_000_000),
            comment=obj(id=F.col("l_partkey"), updated_at=iso(F.col("l_shipdate")), user=user),
            sender=user,
        )
        return as_event(
            lines, "pull_request_review_comment", self._line_id("cm"), F.col("l_shipdate"),
            F.to_json(payload),
        )

    @cached_property
    def commit_lines(self) -> DataFrame:
        """Line items 6 and 7 with their order: one push each."""
        lines = self.lineitem.filter(F.col("l_linenumber") >= 6)
        return lines.join(self.orders, F.col("l_orderkey") == F.col("k"))

    @staticmethod
    def _commit_sha(number: Column) -> Column:
        return F.md5(F.concat_ws("-", text("c", F.col("l_orderkey")), F.col("l_linenumber").cast("string"), number.cast("string")))

    def _commit_numbers(self) -> Column:
        """1..n with n = l_partkey % 4, empty for n = 0."""
        return F.filter(F.array(*(F.lit(i) for i in (1, 2, 3))), lambda i: i <= F.col("l_partkey") % 4)

    @cached_property
    def pushes(self) -> DataFrame:
        k, org, repo = (F.col(c) for c in ("k", "org", "repo"))
        host = F.when(k % 11 == 0, F.lit("https://code.example.com/")).otherwise("https://github.com/")
        commits = F.transform(
            self._commit_numbers(),
            lambda i: obj(
                id=self._commit_sha(i), timestamp=iso(plus(F.col("l_shipdate"), i, "hours"))
            ),
        )
        payload = obj(
            ref=F.when(k % 5 == 0, F.lit("refs/heads/dev")).otherwise("refs/heads/main"),
            compare_url=text(host, org, "/", repo, "/compare/", k),
            pusher=obj(name=login(F.col("ck"))),
            sender=obj(login=login(F.col("ck"))),
            organization=obj(id=F.col("rk") + 1, login=org),
            repository=obj(
                id=F.col("nk") + 100,
                name=repo,
                full_name=text(org, "/", repo),
                html_url=text("https://github.com/", org, "/", repo),
                default_branch=F.lit("main"),
                visibility=F.when(k % 2 == 0, F.lit("private")).otherwise("public"),
            ),
            commits=commits,
        )
        identity = self._identity()
        identity.pop("enterprise_id"), identity.pop("enterprise_name")
        return as_event(
            self.commit_lines, "push", self._line_id("ps"),
            plus(F.col("l_shipdate"), k % 86400, "secs"), F.to_json(payload), **identity,
        )

    @cached_property
    def issues(self) -> DataFrame:
        k, d, org = (F.col(c) for c in ("k", "d", "org"))
        user = obj(login=login(F.col("ck")))
        payload = obj(
            action=F.lit("closed"),
            repository=obj(name=F.lit("breakglass"), full_name=text(org, "/breakglass")),
            organization=obj(id=F.col("rk") + 1, login=org),
            issue=obj(
                id=k + 5_000_000,
                html_url=text("https://github.com/", org, "/breakglass/issues/", k),
                user=user,
                created_at=iso(d),
                closed_at=F.when(k % 3 != 0, iso(d + F.expr("INTERVAL 90 DAYS"))),
            ),
            sender=user,
        )
        urgent = self.orders.filter(F.col("pri") == "1-URGENT")
        return as_event(
            urgent, "issues", text("is-", k), d, F.to_json(payload),
            organization_id=F.col("rk") + 1, organization_name=org,
            repository_name=text(org, "/breakglass"),
        )

    @staticmethod
    def _run_slug() -> tuple[Column, Column]:
        return text("org-", F.col("user_id") % 7), text("repo-", F.col("event_id") % 11)

    @cached_property
    def workflow_runs(self) -> DataFrame:
        e = F.col("event_id")
        org, repo = self._run_slug()
        slug = text(org, "/", repo)

        def pr(offset: int) -> Column:
            number = e + offset
            return obj(id=number + 1_000_000, number=number, url=text("https://api.github.com/pulls/", number))

        prs = (
            F.when(e % 3 == 0, F.array(pr(0)))
            .when(e % 3 == 1, F.array(pr(0), pr(1)))
            .otherwise(F.array().cast("array<struct<id:bigint,number:bigint,url:string>>"))
        )
        payload = obj(
            action=F.when(e % 4 != 0, F.lit("completed")).otherwise("requested"),
            repository=obj(
                id=e % 11 + 1, name=repo, full_name=slug, owner=obj(login=org),
                html_url=text("https://github.com/", slug),
            ),
            sender=obj(login=login(F.col("user_id"))),
            workflow_run=obj(
                id=e,
                head_sha=F.md5(text("h", e)),
                status=F.when(e % 4 != 0, F.lit("completed")).otherwise("queued"),
                logs_url=text("https://api.github.com/repos/", slug, "/actions/runs/", e, "/logs"),
                html_url=text("https://github.com/", slug, "/actions/runs/", e),
                run_attempt=e % 3 + 1,
                actor=obj(login=login(F.col("user_id"))),
                pull_requests=prs,
            ),
        )
        runs = self.activity.filter(F.col("event_type") == "purchase")
        return as_event(
            runs, "workflow_run", text("wr-", e), F.col("ts"), F.to_json(payload),
            repository_id=e % 11 + 1, repository_name=slug,
        )

    @cached_property
    def misc(self) -> DataFrame:
        """Create, workflow_job, deployment_status, deployment and repository events.

        They also carry the odd identities: installation accounts, an empty
        organization object, an id that is text and payloads that are no object.
        """
        e, kind = F.col("event_id"), F.col("event_type")
        is_signup, is_click, is_view, is_error = (
            kind == name for name in ("signup", "click", "view", "error")
        )
        third = e % 3
        event = (
            F.when(is_signup, "create")
            .when(is_click, "workflow_job")
            .when(is_view, "deployment_status")
            .when(e % 2 == 0, "repository")
            .otherwise("deployment")
        )
        action = F.when(
            is_click,
            F.when(third == 0, "queued").when(third == 1, "in_progress").otherwise("completed"),
        ).when(is_error | is_view, "created")
        payload = obj(
            action=action,
            ref=F.when(is_signup, text("topic-", e % 10)),
            ref_type=F.when(
                is_signup, F.when(third == 0, "branch").when(third == 1, "tag").otherwise("other")
            ),
            deployment_status=F.when(
                is_view,
                obj(
                    state=F.when(third == 0, "success").when(third == 1, "failure").otherwise("pending")
                ),
            ),
            sender=obj(login=login(F.col("user_id"))),
            organization=F.when(is_click, obj(login=null())),
            installation=F.when(
                is_signup | is_click,
                obj(
                    account=obj(
                        type=F.when(e % 2 == 0, "Organization").otherwise("User"),
                        id=F.col("user_id"),
                        login=text("org-", F.col("user_id") % 7),
                    )
                ),
            ),
            repository=F.when(
                is_view, obj(id=e.cast("string"), full_name=text("x/", e % 5))
            ),
        )
        broken = F.when(e % 12 == 1, F.lit("[1, 2]")).otherwise('{"action": ')
        body = F.when(is_error & (e % 6 == 1), broken).otherwise(F.to_json(payload))
        rows = self.activity.filter(kind != "purchase")
        return as_event(
            rows, event, text("mi-", e), F.col("ts"), body,
            repository_name=F.when(is_view, text("x/", e % 5)),
        )

    @cached_property
    def events(self) -> DataFrame:
        """Everything an event table would hold."""
        parts = (
            self.pull_requests, self.reviews, self.comments, self.pushes,
            self.issues, self.workflow_runs, self.misc,
        )
        return reduce(DataFrame.unionByName, parts)

    @cached_property
    def prstats_events(self) -> DataFrame:
        return reduce(DataFrame.unionByName, (self.pull_requests, self.reviews, self.comments))

    # -- intake -----------------------------------------------------------

    @cached_property
    def raw_webhooks(self) -> DataFrame:
        """Bodies with right, wrong and missing signatures; some bodies are empty."""
        e = F.col("event_id")
        body = F.when(e % 50 == 1, F.lit("")).otherwise(F.col("props")).cast("binary")
        signed = self.activity.select("event_id", "ts", "event_type", body.alias("body"))
        right = webhook_signature(WEBHOOK_SECRET, F.col("body"))
        wrong = F.when(e % 20 == 0, F.lit("sha256=0000"))
        return signed.select(
            F.md5(e.cast("string")).alias("delivery_id"),
            F.col("event_type").alias("event"),
            F.when(e % 10 == 0, wrong).otherwise(right).alias("signature"),
            F.col("ts").alias("received"),
            "body",
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Push envelopes of the misc events; some with bad base64, some cut short."""
        number = F.substring_index("delivery_id", "-", -1).cast("bigint")
        event = self.misc.select(
            "delivery_id", "signature", iso(F.col("received")).alias("received"), "event", "payload"
        )
        inner = F.to_json(F.struct(*event.columns))
        data = F.when(number % 17 == 0, F.lit("###")).otherwise(F.base64(inner.cast("binary")))
        whole = F.to_json(
            obj(
                message=obj(data=data, messageId=number.cast("string")),
                subscription=F.lit("events"),
            )
        )
        cut = F.substring(whole, F.lit(1), F.length(whole) - 5)
        return event.select(F.when(number % 19 == 0, cut).otherwise(whole).alias("message"))

    # -- state tables -----------------------------------------------------

    @cached_property
    def commits(self) -> DataFrame:
        """Every pushed commit, as the state tables refer to it."""
        return self.commit_lines.select(
            "k", "org", "repo", F.explode(self._commit_numbers()).alias("i"), "l_orderkey", "l_linenumber"
        ).select(
            "k",
            F.col("org").alias("organization"),
            F.col("repo").alias("repository"),
            self._commit_sha(F.col("i")).alias("commit_sha"),
        )

    @cached_property
    def reviewed_commits(self) -> DataFrame:
        return self.commits.filter(F.col("k") % 4 == 0).select("commit_sha")

    @cached_property
    def commit_pull_requests(self) -> DataFrame:
        """One pull request per commit for most orders, a second one for some."""
        k = F.col("k")
        prs = F.filter(
            F.array(
                obj(ordinal=F.lit(0), pr_id=k + 1_000_000, wanted=k % 6 != 0),
                obj(ordinal=F.lit(1), pr_id=k + 1_000_001, wanted=(k % 6 != 0) & (k % 7 == 0)),
            ),
            lambda pr: pr["wanted"],
        )
        return self.commits.distinct().select(
            "*", F.inline(prs)
        ).select(
            "organization", "repository", "commit_sha",
            F.lit("main").alias("default_branch"),
            "ordinal",
            F.when((k % 13 == 0) & (F.col("ordinal") == 0), F.lit("dev")).otherwise("main").alias("base_ref"),
            "pr_id",
            (F.col("pr_id") % 100_000).alias("pr_number"),
            text("https://github.com/pull/", F.col("pr_id")).alias("pr_url"),
        )

    @cached_property
    def lookup_errors(self) -> DataFrame:
        k = F.col("k")
        message = F.when(
            k % 101 == 0,
            text("Could not resolve to a Repository with the name '", F.col("repository"), "'."),
        ).otherwise("timeout")
        failed = self.commits.filter((k % 101 == 0) | (k % 103 == 0))
        return failed.select("organization", "repository", "commit_sha", message.alias("message")).distinct()

    @cached_property
    def artifacts(self) -> DataFrame:
        e = F.col("event_id")
        org, repo = self._run_slug()
        slug = text(org, "/", repo)
        done = self.activity.filter((F.col("event_type") == "purchase") & (e % 5 == 0))
        return done.select(
            text("wr-", e).alias("delivery_id"),
            F.col("ts").alias("processed_at"),
            F.when(e % 3 == 0, "SUCCESS").when(e % 3 == 1, "NOT_FOUND").otherwise("FAILURE").alias("status"),
            text("https://github.com/", slug, "/actions/runs/", e).alias("workflow_uri"),
            text("gs://logs/", slug, "/wr-", e, "/artifacts.tar.gz").alias("logs_uri"),
            login(F.col("user_id")).alias("github_actor"),
            org.alias("organization_name"),
            repo.alias("repository_name"),
            slug.alias("repository_slug"),
            F.lit("").alias("job_name"),
        )

    @cached_property
    def fetch_outcomes(self) -> DataFrame:
        """Answers to the log fetch of each run; some runs never got one."""
        e = F.col("event_id")
        runs = self.activity.filter((F.col("event_type") == "purchase") & (e % 8 != 7))
        code = (
            F.when(e % 8 == 1, 404).when(e % 8 == 2, 410).when(e % 8 == 3, 500).when(e % 8 == 5, null("int")).otherwise(200)
        )
        return runs.select(
            text("wr-", e).alias("delivery_id"),
            code.cast("int").alias("http_status"),
            F.when(e % 8 == 5, F.lit("connection reset")).when(e % 16 == 6, F.lit("write failed")).alias("error"),
        )

    @cached_property
    def comment_posts(self) -> DataFrame:
        """Answers to the first two comments of each run: failed, repeated and missing ones among them."""
        e, n = F.col("event_id"), F.col("position")
        tried = self.activity.filter(F.col("event_type") == "purchase").select(
            "event_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("position")
        )
        refused, broken = (e % 7 == 3) & (n == e % 2), (e % 17 == 4) & (n == 0)
        first = tried.filter(~((e % 13 == 5) & (n == 1))).select(
            text("wr-", e).alias("delivery_id"),
            "position",
            F.when(refused, 403).when(broken, null("int")).otherwise(201).alias("http_status"),
            F.when(broken & ~refused, "connection reset").alias("error"),
        )
        again = tried.filter(refused & (e % 21 == 3)).select(
            text("wr-", e).alias("delivery_id"), "position", F.lit(201).alias("http_status"), null().alias("error")
        )
        return first.unionByName(again)

    @cached_property
    def mixed_pushes(self) -> DataFrame:
        """Pushes whose commit ids are texts, numbers, objects, arrays and nulls by turns."""
        odd = F.col("l_partkey") + F.col("l_suppkey")

        def commit(i: Column) -> Column:
            kind = (odd + i) % 6
            name = (
                F.when(kind == 0, text("{\"id\":", i, "}"))
                .when(kind == 1, text("[\"", i, "\"]"))
                .when(kind == 2, text(i))
                .when(kind == 3, "null")
                .when(kind == 4, text("\"{not an object ", i, "\""))
                .otherwise(text("\"", self._commit_sha(i), "\""))
            )
            return text("{\"id\":", name, ",\"added\":[]}")

        lines = self.lineitem.filter(F.col("l_linenumber") >= 6)
        commits = F.array_join(F.transform(self._commit_numbers(), commit), ",")
        return as_event(
            lines, "push", self._line_id("mx"), F.col("l_shipdate"), text("{\"commits\":[", commits, "]}")
        )

    @cached_property
    def pull_request_events(self) -> DataFrame:
        e = F.col("event_id")
        return self.activity.filter(F.col("event_type") == "purchase").select(
            text("pe-", e).alias("delivery_id"),
            (e + 1_000_000).alias("id"),
            text("https://github.com/org/repo/pull/", e).alias("html_url"),
            plus(F.col("ts"), e % 240, "hours").alias("merged_at"),
        )

    @cached_property
    def invocation_comments(self) -> DataFrame:
        e = F.col("event_id")
        return self.activity.filter(e % 9 == 0).select((e + 1_000_000).alias("pull_request_id"))

    @cached_property
    def failure_events(self) -> DataFrame:
        """``event_id % 4`` earlier failures of each delivery."""
        e = F.col("event_id")
        copies = F.filter(F.array(*(F.lit(i) for i in (1, 2, 3))), lambda i: i <= e % 4)
        return self.activity.select(
            F.md5(e.cast("string")).alias("delivery_id"), F.col("ts"), F.explode(copies).alias("i")
        ).select("delivery_id", plus(F.col("ts"), F.col("i"), "mins").alias("created"))

    @cached_property
    def failed_writes(self) -> DataFrame:
        e = F.col("event_id")
        return self.activity.select(
            F.md5(e.cast("string")).alias("delivery_id"), (e % 5 != 0).alias("dlq_ok")
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        """The host's delivery log."""
        value = F.col("value")
        return self.activity.select(
            F.col("event_id").alias("id"),
            F.md5(F.col("event_id").cast("string")).alias("guid"),
            F.when(value > 80, 500).when(value > 70, 404).otherwise(200).alias("status_code"),
            F.col("event_type").alias("event"),
            F.col("ts").alias("delivered_at"),
        )

    @cached_property
    def arrived(self) -> DataFrame:
        """Deliveries that reached the event table after all: every third one."""
        e = F.col("event_id")
        return self.activity.filter(e % 3 == 0).select(F.md5(e.cast("string")).alias("delivery_id"))

    @cached_property
    def redelivery_outcomes(self) -> DataFrame:
        e = F.col("event_id")
        outcome = F.when(e % 5 == 0, "ok").when(e % 5 == 1, "accepted").otherwise("bad gateway")
        return self.activity.filter(e % 10 != 9).select(e.alias("id"), outcome.alias("outcome"))

    @cached_property
    def checkpoints(self) -> DataFrame:
        """Checkpoints of two hosts; the default one is stored as '' or NULL.

        Ids are text: the newest is the largest number, not the last in text order.
        """
        e = F.col("event_id")
        domain = (
            F.when(e % 3 == 0, F.lit("")).when(e % 3 == 1, null()).otherwise("ghes.example.com")
        )
        return self.activity.filter(F.col("event_type") == "signup").select(
            e.cast("string").alias("delivery_id"),
            F.col("ts").alias("created"),
            domain.alias("github_instance_url"),
        )


# Which events each set consists of, and the sets that are tables of their own.
EVENT_SETS = {
    "pull_requests": ["pull_request"],
    "reviews": ["pull_request_review"],
    "comments": ["pull_request_review_comment"],
    "pushes": ["push"],
    "issues": ["issues"],
    "workflow_runs": ["workflow_run"],
    "misc": ["create", "workflow_job", "deployment_status", "repository", "deployment"],
}
STATE_SETS = [
    "raw_webhooks", "messages",
    "reviewed_commits", "commit_pull_requests", "lookup_errors",
    "artifacts", "fetch_outcomes", "comment_posts", "mixed_pushes", "pull_request_events", "invocation_comments",
    "failure_events", "failed_writes",
    "deliveries", "arrived", "redelivery_outcomes", "checkpoints",
]


class StoredEvents(DerivedEvents):
    """The same sets read from Parquet, the way a deployment would read its tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, path: str):
        super().__init__(spark, sf_dir)
        self.events = spark.read.schema(OPTIMIZED_EVENTS.schema).parquet(f"{path}/events")
        self.prstats_events = self.events
        for name, kinds in EVENT_SETS.items():
            setattr(self, name, self.events.filter(F.col("event").isin(kinds)))
        for name in STATE_SETS:
            setattr(self, name, spark.read.parquet(f"{path}/{name}"))

    @classmethod
    def write(cls, source: DerivedEvents, path: str) -> StoredEvents:
        """Store all sets under ``path``; events are clustered by name inside each file."""
        files = source.spark.sparkContext.defaultParallelism
        events = source.events.repartition(files).sortWithinPartitions("event")
        events.write.parquet(f"{path}/events")
        for name in STATE_SETS:
            getattr(source, name).write.parquet(f"{path}/{name}")
        return cls(source.spark, source.sf_dir, path)
