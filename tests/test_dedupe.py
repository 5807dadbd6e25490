"""Duplicate signals per account against a brute-force search over single partners."""

import random

from cohortium.plans import dedupe as D


def _norm(s):
    return s.replace(" ", "").replace(".", "").lower()


def _frames(spark):
    rnd = random.Random(3)
    stems = ["acme", "acmeco", "ac", "zed", "zed.labs", "blue sky", "bluesky", "b", "q_r", "qxr", "the acme", "big bluesky co"]
    rows, team = [], []
    for i in range(90):
        name = rnd.choice(stems) + rnd.choice(["", " ", ".", " inc"][: (1 if i % 4 else 4)])
        dom = rnd.choice(["acme.io", "gmail.com", "zed.dev", "", "blue.net"])
        rows.append((i, name, f"x{i}@{dom}" if dom else f"x{i}"))
        for _ in range(rnd.choice([0, 0, 1, 2, 3])):
            team.append((i, f"m@{rnd.choice(['t1.com', 't2.com', 't3.com', 't4.com', 'gmail.com', 'solo' + str(i)])}"))
    rows += [(200, "", "x@acme.io"), (201, " . ", "y@acme.io"), (202, None, None)]
    team += [(200, "m@t1.com"), (200, "m@t2.com"), (201, "m@t3.com"), (900, "m@t1.com"), (901, "m@solo901"), (None, "m@t1.com"), (902, None)]
    return rows, team


def test_signals_match_brute_force(spark):
    rows, team = _frames(spark)
    acc = spark.createDataFrame(rows, "customer_id long, company_name string, contact_email string")
    norm = {i: _norm(n) for i, n, _ in rows if n and _norm(n)}
    names = {r.customer_id: r for r in D.name_signals(acc).collect()}
    assert set(names) == set(norm)
    for i, n in norm.items():
        r = names[i]
        assert r.exact_group_size == sum(m == n for m in norm.values())
        assert r.n_shorter_prefix_names == sum(n.startswith(m) and m != n for m in norm.values())
        assert r.n_longer_names == sum(m.startswith(n) and m != n for m in norm.values())


def test_best_partner_matches_brute_force(spark):
    """Score, partner and number of shared team domains, for every account."""
    rows, team = _frames(spark)
    acc = spark.createDataFrame(rows, "customer_id long, company_name string, contact_email string")
    tm = spark.createDataFrame(team, "customer_id long, email string")
    got = {r.customer_id: r for r in D.duplicate_candidates(acc, tm, min_score=0, k=None).collect()}
    norm = {i: _norm(n) for i, n, _ in rows if n and _norm(n)}
    dom = {i: e.split("@")[1] for i, _, e in rows if i in norm and e and "@" in e}
    corp = {i: d for i, d in dom.items() if d not in D.GENERIC_ACCOUNT_DOMAINS}
    teams = {}
    for i, e in team:
        d = e.split("@")[1] if e else "gmail.com"
        if i is not None and d not in D.GENERIC_TEAM_DOMAINS:
            teams.setdefault(i, set()).add(d)

    def base(i, j):
        both = i in corp and corp.get(i) == corp.get(j)
        a, b = norm.get(i), norm.get(j)
        name = 0
        if a and b:
            name = 50 if a == b else 30 if a.startswith(b) or b.startswith(a) else 15 if both and (
                len(a) > 3 and len(b) > 3 and (a in b or b in a)) else 0
        return name + 30 * both

    everyone = set(norm) | set(teams)
    for i in everyone:
        scores = {}
        for j in everyone - {i}:
            shared = len(teams.get(i, set()) & teams.get(j, set()))
            if base(i, j) or shared:
                scores[j] = base(i, j) + (30 if shared >= 2 else 15 if shared else 0)
        if not scores:
            assert i not in got
            continue
        r, best = got[i], max(scores.values())
        assert (r.duplicate_confidence_score, r.linked_id) == (best, min(j for j, x in scores.items() if x == best)), i
        assert r.shared_team_domains == len(teams.get(i, set()) & teams.get(r.linked_id, set())), i
    assert set(got) <= everyone and not {202, 901, 902} & set(got)


def test_signals_of_different_partners_are_not_added(spark):
    acc = spark.createDataFrame([(1, "orchid", "a@x.io"), (2, "orchid", "b@y.io"), (3, "maple", "c@x.io"), (4, "birch", "d@z.io")],
                                "customer_id long, company_name string, contact_email string")
    tm = spark.createDataFrame([(1, "m@t.com"), (4, "m@t.com")], "customer_id long, email string")
    r = {x.customer_id: x for x in D.duplicate_candidates(acc, tm, min_score=0, k=None).collect()}
    assert (r[1].duplicate_confidence_score, r[1].linked_id, r[1].name_match_type) == (50, 2, "EXACT_MATCH")
    assert (r[3].duplicate_confidence_score, r[3].linked_id, r[3].corporate_domain_match) == (30, 1, True)
    assert (r[4].duplicate_confidence_score, r[4].linked_id) == (15, 1)


def test_substrings_count_inside_a_corporate_domain(spark):
    acc = spark.createDataFrame([(1, "maple", "a@x.io"), (2, "old maple", "b@x.io"), (3, "new maple", "b@y.io"), (4, "map", "c@y.io")],
                                "customer_id long, company_name string, contact_email string")
    tm = spark.createDataFrame([], "customer_id long, email string")
    r = {x.customer_id: x for x in D.duplicate_candidates(acc, tm, min_score=0, k=None).collect()}
    assert (r[1].duplicate_confidence_score, r[1].linked_id, r[1].name_match_type) == (45, 2, "SUBSTRING_MATCH")
    assert r[3].duplicate_confidence_score == 30 and r[3].name_match_type is None


def test_top_k_is_a_report(spark):
    acc = spark.createDataFrame([(i, "same", f"a{i}@corp.io") for i in range(80)],
                                "customer_id long, company_name string, contact_email string")
    tm = spark.createDataFrame([], "customer_id long, email string")
    r = D.duplicate_candidates(acc, tm).collect()
    assert len(r) == 50 and [x.customer_id for x in r] == list(range(50))
    assert all(x.duplicate_confidence_score == 80 and x.linked_id == (1 if x.customer_id == 0 else 0) for x in r)


def test_domains_shared_with_different_partners_are_not_added(spark):
    """1 shares t with 2 and u with 3: two domains, but no partner holds both; 4 and 5 share both."""
    acc = spark.createDataFrame([(i, "orchid" if i < 4 else f"n{i}x", f"a@x{i}.io") for i in range(1, 6)], "customer_id long, company_name string, contact_email string")
    tm = spark.createDataFrame([(1, "m@t.com"), (1, "m@u.com"), (2, "m@t.com"), (3, "m@u.com"), (4, "m@v.com"), (4, "m@w.com"), (5, "m@v.com"), (5, "m@w.com"),
                                (5, "m@t.com")], "customer_id long, email string")
    r = {x.customer_id: x for x in D.duplicate_candidates(acc, tm, min_score=0, k=None).collect()}
    assert (r[1].duplicate_confidence_score, r[1].linked_id, r[1].shared_team_domains) == (65, 2, 1)
    assert (r[4].duplicate_confidence_score, r[4].linked_id, r[4].shared_team_domains) == (30, 5, 2)


def test_hot_names_and_domains(spark):
    """A third of all accounts share a name and a team domain; heavy keys give the same rows as plain joins."""
    n = 300
    acc = spark.createDataFrame([(i, "same co" if i % 3 == 0 else f"firm{i}", "a@corp.io" if i % 3 == 0 else f"a@d{i}.io") for i in range(n)],
                                "customer_id long, company_name string, contact_email string")
    tm = spark.createDataFrame([(i, "m@hot.com") for i in range(0, n, 3)] + [(i, f"m@t{i // 2}.com") for i in range(n)], "customer_id long, email string")
    r = {x.customer_id: x for x in D.duplicate_candidates(acc, tm, min_score=0, k=None).collect()}
    assert len(r) == n and all(r[i].duplicate_confidence_score == 95 and r[i].linked_id == (0 if i else 3) for i in range(0, n, 3))
    names = {x.customer_id: x for x in D.name_signals(acc).collect()}
    assert len(names) == n and {names[i].exact_group_size for i in range(0, n, 3)} == {100} and names[1].n_longer_names == sum(
        f"firm{j}".startswith("firm1") and j != 1 for j in range(n) if j % 3)
    assert {x.domain_group_size for x in D.domain_signals(acc).where("customer_id % 3 = 0").collect()} == {100}
    over = {x.customer_id: x.overlapping_domains for x in D.team_domain_overlap(tm).collect()}
    assert over[0] == "hot.com, t0.com" and over[1] == "t0.com" and len(over) == n


def test_contained_names_by_their_rarest_gram(spark):
    rnd = random.Random(11)
    names = sorted({(d, "".join(rnd.choice("ab%_") for _ in range(rnd.randrange(1, 14)))) for d in ("x", "y") for _ in range(60)})
    df = spark.createDataFrame(names, "dom string, norm_name string")
    got = {(r.dom, r.norm_name, r.part) for r in D.contained_names(df).collect()}
    assert got == {(d, a, b) for d, a in names for e, b in names if d == e and len(b) > 3 and b in a[1:]}
    assert D.grams(df).count() <= sum(max(0, len(n) - 3) for _, n in names)


def _dense(spark, seed, n=70, pool=9, most=5):
    """Accounts of few names and domains; teams of up to ``most`` of ``pool`` domains."""
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["acme", "acme co", "old acme", "zed", "solo" + str(i)]), f"x@{rnd.choice(['acme.io', 'zed.dev', 'gmail.com'])}") for i in range(1, n)]
    team = [(i, f"m@t{t}.com") for i in range(1, n + 5) for t in rnd.sample(range(pool), rnd.randrange(most + 1))]
    team += rnd.sample(team, 20)
    return (spark.createDataFrame(rows, "customer_id long, company_name string, contact_email string"),
            spark.createDataFrame(team, "customer_id long, email string"), rows, team)


def test_best_partner_with_many_team_domains(spark):
    """Whole rows against all pairs, where nearest partners share none, one or two domains."""
    for seed, pool, most in ((1, 9, 5), (2, 30, 4)):
        acc, tm, rows, team = _dense(spark, seed, pool=pool, most=most)
        got = {r.customer_id: tuple(r)[1:] for r in D.duplicate_candidates(acc, tm, min_score=0, k=None).collect()}
        name = {i: _norm(n) for i, n, _ in rows}
        corp = {i: e.split("@")[1] for i, _, e in rows if "gmail" not in e}
        teams = {}
        for i, e in team:
            teams.setdefault(i, set()).add(e)
        want = {}
        for i in set(name) | set(teams):
            for j in (set(name) | set(teams)) - {i}:
                dom = i in corp and corp[i] == corp.get(j)
                a, b = sorted((name.get(i, ""), name.get(j, "")), key=len)
                kind = None if not a else "EXACT_MATCH" if a == b else "PREFIX_MATCH" if b.startswith(a) else \
                    "SUBSTRING_MATCH" if dom and len(a) > 3 and a in b else None
                shared = len(teams.get(i, set()) & teams.get(j, set()))
                score = {"EXACT_MATCH": 50, "PREFIX_MATCH": 30, "SUBSTRING_MATCH": 15, None: 0}[kind] + 30 * dom + 15 * min(shared, 2)
                if score and (score, -j) > want.get(i, ((0, 0),))[0]:
                    want[i] = (score, -j), (j, kind, dom, shared, score)
        assert got == {i: w for i, (_, w) in want.items()}


def test_pairs_of_domains_only_for_who_is_left(spark, monkeypatch):
    """The nearest partner shares two domains of nearly everyone, so only the others list pairs."""
    n, rows = 60, {}
    acc = spark.createDataFrame([(i, "same co", "a@corp.io") for i in range(n)], "customer_id long, company_name string, contact_email string")
    tm = spark.createDataFrame([(i, f"m@t{t}.com") for i in range(n - 1) for t in range(12)] + [(n - 1, "m@t0.com"), (n - 1, "m@u.com")], "customer_id long, email string")
    whole = D._partnered

    def counted(links, keys, asking=None):
        rows[len(keys)] = links.count()
        return whole(links, keys, asking)

    monkeypatch.setattr(D, "_partnered", counted)
    r = {x.customer_id: tuple(x)[1:] for x in D.duplicate_candidates(acc, tm, min_score=0, k=None).collect()}
    assert r == {i: (0 if i else 1, "EXACT_MATCH", True, 12, 110) for i in range(n - 1)} | {n - 1: (0, "EXACT_MATCH", True, 1, 95)}
    assert rows[3] <= n, rows
