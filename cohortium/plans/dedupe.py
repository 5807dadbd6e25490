"""Duplicate-account signals, computed per account (no pair enumeration).

The reference lists every *pair* of accounts that share a normalised name,
a name prefix, a corporate e-mail domain or team-member domains, then
scores pairs. Pair lists grow with the square of a block: one common name
or one shared domain holding a third of all accounts would emit ~N²/18
pairs. Here each signal is computed per account with equi-joins and
aggregates that are linear in the number of accounts:

* exact name: size of the account's normalised-name group;
* prefix: proper prefixes of the *distinct* names (bounded by name length)
  are joined to the distinct names, in both directions;
* substring (inside a corporate domain): a q-gram index of the distinct
  names. A name is looked up by its rarest gram only, and what that finds is
  verified, so the rows are linear in name length;
* corporate domain: size of the account's non-generic e-mail domain group;
* team domains: the account's distinct team-member domains that at least
  one other account also has (count and sorted list, bounded by the
  account's own domains).

A name, prefix or domain may be that of a third of all accounts, so accounts
meet these per-key results through :func:`lookup_join`, which never shuffles
the rows of a heavy key.

``duplicate_candidates`` scores each account's best single partner with the
reference's weights: 50 exact / 30 prefix / 15 substring (inside a shared
corporate domain), +30 shared corporate domain, +30 two or more / +15 one
shared team domain; scores of at least 30 are reported, top 50 first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.functions.text import email_domain, normalize_company_name
from cohortium.operators.hotkeys import lookup_join
from cohortium.session import ensure_checkpoint_dir

# Fixed values from the reference: generic e-mail domains ignored for account e-mails.
GENERIC_ACCOUNT_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "protonmail.com",
                           "company.io", "enterprise.com", "startup.co", "corp.net", "tech.dev"]
# Fixed values from the reference: generic domains ignored for team-member e-mails.
GENERIC_TEAM_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "protonmail.com"]
# Fixed values from the reference: signal weights and the reporting cut-off.
WEIGHTS = dict(exact=50, prefix=30, substring=15, domain=30, team_two=30, team_one=15)
MIN_SCORE = 30
TOP_K = 50
# Fixed value from the reference: names of at most three characters are no substrings.
GRAM = 4


def normalized_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts with a usable name: norm_name non-empty (a blank name would prefix every other)."""
    a = accounts.where(F.col("company_name").isNotNull() & (F.col("company_name") != ""))
    a = a.withColumns({"norm_name": normalize_company_name(F.col("company_name")),
                       "email_domain": email_domain(F.col("contact_email"))})
    return a.where(F.col("norm_name") != "")


def _prefixes(names: DataFrame) -> DataFrame:
    """``names`` with every proper prefix of ``norm_name`` as ``prefix``, a row each."""
    return names.where(F.length("norm_name") > 1) \
        .select("*", F.explode(F.sequence(F.lit(1), F.length("norm_name") - 1)).alias("k")) \
        .withColumn("prefix", F.substring("norm_name", F.lit(1), F.col("k"))).drop("k")


def name_signals(accounts: DataFrame) -> DataFrame:
    """Per account: exact-name group size and the number of accounts in a proper-prefix
    relation with it (in each direction). LIKE wildcards are not interpreted."""
    ensure_checkpoint_dir(accounts.sparkSession)
    a = normalized_accounts(accounts).select("customer_id", "norm_name")
    names = a.groupBy("norm_name").agg(F.count(F.lit(1)).alias("exact_group_size")).checkpoint()
    prefixes = _prefixes(names)
    # names that are a proper prefix of mine, weighted by how many accounts carry them
    sizes = names.select(F.col("norm_name").alias("prefix"), F.col("exact_group_size").alias("n"))
    shorter = lookup_join(prefixes.select("norm_name", "prefix"), sizes, ["prefix"]) \
        .groupBy("norm_name").agg(F.sum("n").alias("n_shorter_prefix_names"))
    # accounts whose name extends mine
    longer = prefixes.groupBy(F.col("prefix").alias("norm_name")).agg(F.sum("exact_group_size").alias("n_longer_names"))
    each = names.join(shorter, "norm_name", "left").join(longer, "norm_name", "left").checkpoint()
    out = lookup_join(a, each, ["norm_name"])
    return out.select("customer_id", "norm_name", "exact_group_size",
                      F.coalesce("n_shorter_prefix_names", F.lit(0)).cast("long").alias("n_shorter_prefix_names"),
                      F.coalesce("n_longer_names", F.lit(0)).cast("long").alias("n_longer_names"))


def domain_signals(accounts: DataFrame, generic=GENERIC_ACCOUNT_DOMAINS) -> DataFrame:
    """Per account: e-mail domain, whether it is corporate, and its group size."""
    a = normalized_accounts(accounts).select("customer_id", "email_domain")
    corp = (F.col("email_domain") != "") & ~F.col("email_domain").isin(*generic)
    sizes = a.where(corp).groupBy("email_domain").agg(F.count(F.lit(1)).alias("domain_group_size"))
    out = lookup_join(a, sizes, ["email_domain"], "left")
    return out.select("customer_id", "email_domain", corp.alias("is_corporate_domain"),
                      F.coalesce("domain_group_size", F.lit(0)).cast("long").alias("domain_group_size"))


def team_domain_overlap(team_members: DataFrame, generic=GENERIC_TEAM_DOMAINS) -> DataFrame:
    """Per account: distinct team-member domains shared with at least one other account."""
    tm = team_members.select("customer_id", email_domain(F.col("email")).alias("domain")) \
        .where(~F.col("domain").isin(*generic)).distinct()
    shared = tm.groupBy("domain").agg(F.count(F.lit(1)).alias("holders")).where(F.col("holders") >= 2).select("domain")
    return lookup_join(tm, shared, ["domain"], "left_semi").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("shared_domains"),
        F.array_join(F.array_sort(F.collect_list("domain")), ", ").alias("overlapping_domains"))


def grams(names: DataFrame, size: int = GRAM) -> DataFrame:
    """Distinct (dom, norm_name, gram): the runs of ``size`` characters of each name."""
    starts = F.sequence(F.lit(1), F.length("norm_name") - (size - 1))
    runs = F.array_distinct(F.transform(starts, lambda i: F.substring("norm_name", i, F.lit(size))))
    return names.where(F.length("norm_name") >= size).select("dom", "norm_name", F.explode(runs).alias("gram"))


def contained_names(names: DataFrame) -> DataFrame:
    """(dom, norm_name, part): names of a domain (distinct rows ``dom, norm_name``) that hold
    another one, ``part``, of ``GRAM`` characters or more, somewhere after their start.

    Every part is looked up by the one of its grams that fewest names of the domain have.
    """
    index = grams(names).checkpoint()
    held = index.groupBy("dom", "gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = index.join(held, ["dom", "gram"]).groupBy("dom", F.col("norm_name").alias("part")).agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    found = index.join(rarest.checkpoint(), ["dom", "gram"])
    return found.where(F.contains(F.substr("norm_name", F.lit(2)), F.col("part"))).select("dom", "norm_name", "part")


def name_links(accounts: DataFrame, weights=WEIGHTS, generic=GENERIC_ACCOUNT_DOMAINS) -> DataFrame:
    """Rows ``(customer_id, key, side, base, kind)``: whom a name or domain may link an account to.

    Accounts of one ``key`` are partners if both are on side ``both``, or one is
    ``short`` and the other ``long``. Keys with the domain in them carry its weight
    too, so the partners of one key all hold the same signals. An account has a row
    per prefix of its name and (inside a corporate domain) per name that its own contains.
    """
    ensure_checkpoint_dir(accounts.sparkSession)
    a = normalized_accounts(accounts).select("customer_id", "norm_name", "email_domain")
    corp = (F.col("email_domain") != "") & ~F.col("email_domain").isin(*generic)
    a = a.withColumn("dom", F.when(corp, F.col("email_domain")))
    size = F.length("norm_name")

    def rows(frame, tag, parts, side, base, kind):
        key = F.concat_ws("|", F.lit(tag), *parts)
        return frame.select("customer_id", key.alias("key"), F.lit(side).alias("side"), F.lit(base).alias("base"), F.lit(kind).alias("kind"))

    owned = a.where("dom IS NOT NULL")
    prefixes = _prefixes(a).withColumnRenamed("prefix", "part")
    subs = owned.join(contained_names(owned.select("dom", "norm_name").distinct()), ["dom", "norm_name"])
    both_dom = weights["domain"]
    name, dom, part = F.col("norm_name"), F.col("dom"), F.col("part")
    out = rows(a, "E", [name], "both", weights["exact"], "EXACT_MATCH")
    for more in (
        rows(owned, "ED", [dom, name], "both", weights["exact"] + both_dom, "EXACT_MATCH"),
        rows(a, "P", [name], "short", weights["prefix"], "PREFIX_MATCH"),
        rows(prefixes, "P", [part], "long", weights["prefix"], "PREFIX_MATCH"),
        rows(owned, "PD", [dom, name], "short", weights["prefix"] + both_dom, "PREFIX_MATCH"),
        rows(prefixes.where("dom IS NOT NULL"), "PD", [dom, part], "long", weights["prefix"] + both_dom, "PREFIX_MATCH"),
        rows(owned.where(size > 3), "SD", [dom, name], "short", weights["substring"] + both_dom, "SUBSTRING_MATCH"),
        rows(subs, "SD", [dom, part], "long", weights["substring"] + both_dom, "SUBSTRING_MATCH"),
        rows(owned, "D", [dom], "both", both_dom, None),
    ):
        out = out.unionByName(more)
    return out.withColumn("kind", F.col("kind").cast("string")).distinct()


def _partnered(links: DataFrame, keys: list[str], asking: DataFrame | None = None) -> DataFrame:
    """Rows of ``asking`` (default: all ``links``) that have a partner among ``links`` on the
    other side, with the smallest other account id.

    Groups are only aggregated (smallest and second smallest id), never listed; the
    results are kept, so that a join to a hot key can be split.
    """
    least = links.groupBy(*keys, "side").agg(F.min("customer_id").alias("m1")).checkpoint()
    rest = links.where("side = 'both'").join(least, [*keys, "side"]).where("customer_id > m1") \
        .groupBy(*keys, "side").agg(F.min("customer_id").alias("m2"))
    least = least.join(rest, [*keys, "side"], "left")
    other = least.withColumn("side", F.when(F.col("side") == "short", "long").when(F.col("side") == "long", "short").otherwise(F.col("side")))
    x = (links if asking is None else asking).join(other.checkpoint(), [*keys, "side"])
    linked = F.when((F.col("side") == "both") & (F.col("m1") == F.col("customer_id")), F.col("m2")).otherwise(F.col("m1"))
    return x.withColumn("linked_id", linked).drop("m1", "m2").where("linked_id IS NOT NULL")


def _shared_domains(rows: DataFrame, domains: DataFrame) -> DataFrame:
    """``rows`` with ``shared``, the number of team domains that ``customer_id`` and ``linked_id`` both have."""
    theirs = domains.select(F.col("customer_id").alias("linked_id"), F.col("domains").alias("theirs"))
    # a small id may be the partner of very many
    x = lookup_join(rows, theirs, ["linked_id"], "left").join(domains, "customer_id", "left")
    both = F.array_intersect("domains", "theirs")
    return x.withColumn("shared", F.when(both.isNotNull(), F.size(both)).otherwise(0).cast("long")).drop("domains", "theirs")


def _domain_pairs(held: DataFrame, group: list[str]) -> DataFrame:
    """A row per pair (``domain`` before ``second``) of the sorted ``domains``."""
    firsts = held.select(*group, "domains", F.posexplode("domains").alias("at", "domain"))
    return firsts.select(*group, "domain", F.explode(F.slice("domains", F.col("at") + 2, F.size("domains"))).alias("second"))


def duplicate_candidates(accounts: DataFrame, team_members: DataFrame, min_score: int = MIN_SCORE,
                         k: int | None = TOP_K, weights=WEIGHTS, generic_account=GENERIC_ACCOUNT_DOMAINS,
                         generic_team=GENERIC_TEAM_DOMAINS) -> DataFrame:
    """Each account's best single partner by the four signals; ``k=None`` keeps all.

    The signals of a score all belong to one partner. Partners that share the same name
    relation and, where it counts, the same corporate domain form a group. Within it an
    account meets the others by each team domain (one shared) and by each *pair* of the
    domains that it has (two shared by the same partner). Both are
    equi-joins on aggregated groups: no pair of accounts is listed, and rows grow with an
    account's own domains only. An account asks only in groups that could still beat, by two
    shared domains, what it has without them. ``linked_id`` is the smallest other account that earns the
    score, ``shared_team_domains`` the exact number of team domains shared with it.

    Most accounts need neither step: where the smallest partner of a group, or the smallest that
    shares a domain, shares two, no other of that group is better. So the smallest partner in
    the best group is looked at first, and pairs are listed only for who is left, in the groups
    and of the domains that these ask for.
    """
    ensure_checkpoint_dir(accounts.sparkSession)
    domains = team_members.select("customer_id", email_domain(F.col("email")).alias("domain")) \
        .where(F.col("customer_id").isNotNull() & (F.col("domain") != "") & ~F.col("domain").isin(*generic_team)) \
        .groupBy("customer_id").agg(F.array_sort(F.collect_set("domain")).alias("domains")).checkpoint()
    group = ["customer_id", "key", "side", "base", "kind"]
    links = _partnered(name_links(accounts, weights, generic_account).checkpoint(), ["key"]).checkpoint()
    everyone = domains.select("customer_id", F.lit("*").alias("key"), F.lit("both").alias("side"), F.lit(0).alias("base"),
                              F.lit(None).cast("string").alias("kind"), F.lit(None).cast(links.schema["linked_id"].dataType).alias("linked_id"))
    one_more, two_more = F.lit(weights["team_one"]), F.lit(weights["team_two"])

    def may_win(rows: DataFrame, reached: DataFrame) -> DataFrame:
        """Rows whose base and two shared domains, with no partner before ``linked_id``, could
        still beat the score and partner that their account has ``reached``."""
        most = F.col("base") + two_more
        x = rows.join(reached, "customer_id", "left")
        tie = (most == F.col("reached")) & F.coalesce(F.col("linked_id") <= F.col("nearest"), F.lit(True))
        return x.where(F.col("reached").isNull() | (most > F.col("reached")) | tie).drop("reached", "nearest")

    # the smallest partner of the best group: nobody there is better if it shares two domains
    first = links.groupBy("customer_id").agg(F.max_by(F.struct(*group[1:], "linked_id"), F.struct(F.col("base"), -F.col("linked_id"), F.col("key"), F.col("side"))).alias("f"))
    first = _shared_domains(first.select("customer_id", "f.*").checkpoint(), domains)
    first = first.withColumn("earned", F.when(F.col("shared") > 1, two_more).when(F.col("shared") == 1, one_more).otherwise(0)).checkpoint()
    reached = first.select("customer_id", (F.col("base") + F.col("earned")).alias("reached"), F.col("linked_id").alias("nearest"),
                           F.when(F.col("shared") > 1, F.struct("key", "side")).alias("settled"))
    every = links.unionByName(everyone)
    asking = may_win(every, reached).where(F.col("settled").isNull() | (F.struct("key", "side") != F.col("settled"))).select(*group).checkpoint()
    # whoever is asked answers in that group, even where it has better ones itself
    asked = every.select(*group).join(asking.select("key").distinct(), "key", "left_semi")
    each = F.explode("domains").alias("domain")
    sharing = _partnered(asked.join(domains, "customer_id").checkpoint().select(*group, each), ["key", "domain"],
                         asking.join(domains, "customer_id").select(*group, each))
    # the smallest one that shares a domain is the smallest one of every domain shared with it
    one = sharing.groupBy(*group).agg(F.array_sort(F.collect_list("linked_id")).alias("ids")).withColumn("linked_id", F.col("ids")[0])
    one = one.select(*group, "linked_id", F.size("ids").alias("met"), F.size(F.filter("ids", lambda i: i == F.col("linked_id"))).alias("shared"))
    one = one.withColumn("earned", F.when(F.col("shared") > 1, two_more).otherwise(one_more)).checkpoint()
    got = first.select("customer_id", "base", "earned", "linked_id").unionByName(one.select("customer_id", "base", "earned", "linked_id"))
    reached = got.groupBy("customer_id").agg(F.max(F.struct((F.col("base") + F.col("earned")).alias("reached"), (-F.col("linked_id")).alias("near"))).alias("r")) \
        .select("customer_id", "r.reached", (-F.col("r.near")).alias("nearest"))
    asking = may_win(one.where("met > 1 AND shared = 1"), reached).select(*group).join(domains, "customer_id").checkpoint()
    wanted = asking.select("key", each).distinct().checkpoint()
    asked = every.select(*group).join(wanted.select("key").distinct(), "key", "left_semi")
    held = asked.join(domains, "customer_id").select(*group, each).join(wanted, ["key", "domain"], "left_semi") \
        .groupBy(*group).agg(F.array_sort(F.collect_list("domain")).alias("domains")).where(F.size("domains") > 1).checkpoint()
    two = _partnered(_domain_pairs(held, group), ["key", "domain", "second"], _domain_pairs(asking, group)) \
        .groupBy(*group).agg(F.min("linked_id").alias("linked_id"))
    scored = links.withColumn("earned", F.lit(0)).unionByName(first.drop("shared")) \
        .unionByName(one.drop("met", "shared")) \
        .unionByName(two.withColumn("earned", two_more))
    score = F.col("base") + F.col("earned")
    # highest score, then the smallest partner, then the stronger name relation
    order = F.struct(score.alias("score"), (-F.col("linked_id")).alias("near"), F.col("base"), F.col("key"), F.col("side"))
    best = scored.groupBy("customer_id").agg(F.max_by(F.struct("linked_id", "kind", "key", score.alias("score")), order).alias("b"))
    best = best.select("customer_id", F.col("b.linked_id").alias("linked_id"), F.col("b.kind").alias("name_match_type"),
                       F.substring_index("b.key", "|", 1).isin("ED", "PD", "SD", "D").alias("corporate_domain_match"),
                       F.col("b.score").alias("duplicate_confidence_score")).where(F.col("duplicate_confidence_score") >= min_score)
    best = best.orderBy(F.desc("duplicate_confidence_score"), "customer_id")
    best = (best.limit(k) if k else best).checkpoint()
    # the domains shared with this one partner
    return _shared_domains(best, domains).select(
        "customer_id", "linked_id", "name_match_type", "corporate_domain_match",
        F.col("shared").alias("shared_team_domains"), "duplicate_confidence_score") \
        .orderBy(F.desc("duplicate_confidence_score"), "customer_id")
