"""Registered duplicate-account queries (per-account signals, no pair lists)."""

from __future__ import annotations

from cohortium.catalog import register
from cohortium.plans import dedupe as D
from cohortium.sources import bindings as B
from cohortium.sources.bindings import TEST_GENERIC_ACCOUNT_DOMAINS, TEST_GENERIC_TEAM_DOMAINS, sql_with


def _in(vals):
    return ", ".join(f"'{v}'" for v in vals)


# accounts whose name is not blank once spaces and full stops are gone
NA = ("na", """WITH spelled AS (SELECT customer_id, contact_email, translate(company_name, ' .', '') AS packed FROM accounts)
    SELECT customer_id, lower(packed) AS norm_name, lower(split_part(contact_email, '@', 2)) AS email_domain
    FROM spelled WHERE length(packed) > 0""")
NAME_CTES = [
    NA,
    ("names", "SELECT norm_name, COUNT(*) AS exact_group_size FROM na GROUP BY 1"),
    ("pref", """SELECT customer_id, substr(norm_name, 1, k) AS prefix FROM (
        SELECT customer_id, norm_name, unnest(range(1, length(norm_name))) AS k FROM na) x"""),
    ("shorter", """SELECT p.customer_id, SUM(n.exact_group_size) AS s FROM pref p
        JOIN names n ON p.prefix = n.norm_name GROUP BY 1"""),
    ("longer", "SELECT prefix AS norm_name, COUNT(*) AS c FROM pref GROUP BY 1"),
    ("name_sig", """SELECT na.customer_id, na.norm_name, names.exact_group_size,
        CAST(COALESCE(shorter.s, 0) AS BIGINT) AS n_shorter_prefix_names,
        CAST(COALESCE(longer.c, 0) AS BIGINT) AS n_longer_names
        FROM na JOIN names ON na.norm_name = names.norm_name
        LEFT JOIN shorter ON na.customer_id = shorter.customer_id LEFT JOIN longer ON na.norm_name = longer.norm_name"""),
]
DOMAIN_CTES = [
    ("dsize", f"""SELECT email_domain, COUNT(*) AS n FROM na
        WHERE email_domain <> '' AND email_domain NOT IN ({_in(TEST_GENERIC_ACCOUNT_DOMAINS)}) GROUP BY 1"""),
    ("dom_sig", f"""SELECT na.customer_id, na.email_domain,
        (na.email_domain <> '' AND na.email_domain NOT IN ({_in(TEST_GENERIC_ACCOUNT_DOMAINS)})) AS is_corporate_domain,
        CAST(COALESCE(dsize.n, 0) AS BIGINT) AS domain_group_size
        FROM na LEFT JOIN dsize ON na.email_domain = dsize.email_domain"""),
]
TEAM_CTES = [
    ("tm", f"""SELECT DISTINCT customer_id, lower(split_part(email, '@', 2)) AS domain FROM account_team_members
        WHERE lower(split_part(email, '@', 2)) NOT IN ({_in(TEST_GENERIC_TEAM_DOMAINS)})"""),
    ("holders", "SELECT domain, COUNT(*) AS h FROM tm GROUP BY 1"),
    ("team_sig", """SELECT tm.customer_id, COUNT(*) AS shared_domains,
        string_agg(tm.domain, ', ' ORDER BY tm.domain) AS overlapping_domains
        FROM tm JOIN holders ON tm.domain = holders.domain WHERE holders.h >= 2 GROUP BY 1"""),
]


def _accounts(spark, d):
    return B.accounts(spark, d)


@register("name_prefix_signals", sql_with(["accounts"], "SELECT * FROM name_sig", NAME_CTES))
def name_prefix_signals(spark, d):
    return D.name_signals(_accounts(spark, d))


@register("corporate_domain_groups", sql_with(["accounts"], "SELECT * FROM dom_sig", [NA] + DOMAIN_CTES))
def corporate_domain_groups(spark, d):
    return D.domain_signals(_accounts(spark, d), TEST_GENERIC_ACCOUNT_DOMAINS)


@register("team_domain_overlap", sql_with(["account_team_members"], "SELECT * FROM team_sig", TEAM_CTES))
def team_domain_overlap(spark, d):
    return D.team_domain_overlap(B.account_team_members(spark, d), TEST_GENERIC_TEAM_DOMAINS)


# every partner of an account under each name or domain relation, pair by pair
_OWN = f"CASE WHEN email_domain <> '' AND email_domain NOT IN ({_in(TEST_GENERIC_ACCOUNT_DOMAINS)}) THEN email_domain END"
PAIR_CTES = [
    ("ac", f"SELECT customer_id AS id, norm_name AS nm, {_OWN} AS dom FROM na"),
    ("rel", """SELECT x.id, y.id AS other, 'E' AS tag, x.nm AS grp, 'both' AS side FROM ac x JOIN ac y ON x.nm = y.nm AND x.id <> y.id
        UNION ALL SELECT x.id, y.id, 'P', y.nm, 'long' FROM ac x JOIN ac y ON starts_with(x.nm, y.nm) AND x.nm <> y.nm
        UNION ALL SELECT x.id, y.id, 'P', x.nm, 'short' FROM ac x JOIN ac y ON starts_with(y.nm, x.nm) AND x.nm <> y.nm
        UNION ALL SELECT x.id, y.id, 'SD', y.nm, 'long' FROM ac x JOIN ac y ON x.dom = y.dom
          AND contains(substr(x.nm, 2), y.nm) AND length(y.nm) > 3
        UNION ALL SELECT x.id, y.id, 'SD', x.nm, 'short' FROM ac x JOIN ac y ON x.dom = y.dom
          AND contains(substr(y.nm, 2), x.nm) AND length(x.nm) > 3"""),
    ("linked", """SELECT r.*, CASE tag WHEN 'E' THEN 50 WHEN 'P' THEN 30 ELSE 45 END AS base FROM rel r
        UNION ALL SELECT r.id, r.other, r.tag || 'D', r.grp, r.side, CASE tag WHEN 'E' THEN 80 ELSE 60 END
          FROM rel r JOIN ac x ON r.id = x.id JOIN ac y ON r.other = y.id AND x.dom = y.dom WHERE tag <> 'SD'
        UNION ALL SELECT x.id, y.id, 'D', x.dom, 'both', 30 FROM ac x JOIN ac y ON x.dom = y.dom AND x.id <> y.id"""),
    ("common", """SELECT t.customer_id AS id, u.customer_id AS other, COUNT(*) AS shared
        FROM tm t JOIN tm u ON t.domain = u.domain AND t.customer_id <> u.customer_id GROUP BY ALL"""),
    ("met", """SELECT l.id, l.other, l.tag, l.grp, l.side, l.base, COALESCE(c.shared, 0) AS shared
        FROM linked l LEFT JOIN common c ON l.id = c.id AND l.other = c.other
        UNION ALL SELECT id, other, '*', '', 'both', 0, shared FROM common"""),
    ("scored", "SELECT *, base + CASE WHEN shared >= 2 THEN 30 WHEN shared = 1 THEN 15 ELSE 0 END AS score FROM met"),
]


@register("duplicate_candidates", sql_with(["accounts", "account_team_members"], """
SELECT id AS customer_id, other AS linked_id,
       CASE tag WHEN 'E' THEN 'EXACT_MATCH' WHEN 'ED' THEN 'EXACT_MATCH' WHEN 'P' THEN 'PREFIX_MATCH'
                WHEN 'PD' THEN 'PREFIX_MATCH' WHEN 'SD' THEN 'SUBSTRING_MATCH' END AS name_match_type,
       tag IN ('ED', 'PD', 'SD', 'D') AS corporate_domain_match, CAST(shared AS BIGINT) AS shared_team_domains,
       score AS duplicate_confidence_score
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY score DESC, other, base DESC, tag DESC, grp DESC, side DESC) AS nth
      FROM scored) r
WHERE nth = 1 AND score >= 30 ORDER BY score DESC, id LIMIT 50""", [NA] + TEAM_CTES[:1] + PAIR_CTES))
def duplicate_candidates(spark, d):
    return D.duplicate_candidates(_accounts(spark, d), B.account_team_members(spark, d),
                                  generic_account=TEST_GENERIC_ACCOUNT_DOMAINS, generic_team=TEST_GENERIC_TEAM_DOMAINS)
