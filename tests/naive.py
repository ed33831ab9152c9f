"""Plain Python forms of the definitions, to check the operators against on small inputs."""

from __future__ import annotations

from collections import defaultdict
from itertools import combinations
from math import sqrt


def sets_of(members):
    found = defaultdict(set)
    for entity, element in members:
        found[entity].add(element)
    return found


def similar(members, threshold):
    sets = sets_of(members)
    pairs = {}
    for x, y in combinations(sorted(sets), 2):
        sim = len(sets[x] & sets[y]) / len(sets[x] | sets[y])
        if sim >= threshold and sets[x] & sets[y]:
            pairs[x, y] = round(sim, 9)
    return pairs


def pearson(first, second):
    common = first.keys() & second.keys()
    xs, ys = [first[c] for c in common], [second[c] for c in common]
    mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
    top = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    bottom = sqrt(sum((x - mx) ** 2 for x in xs)) * sqrt(sum((y - my) ** 2 for y in ys))
    return top / bottom if top > 1e-12 and bottom > 0 else 0


def latest(ratings):
    """ratings: (user, item, stars, order)."""
    last = {}
    for user, item, stars, order in ratings:
        key = (order, stars)
        if (user, item) not in last or key > last[user, item][0]:
            last[user, item] = (key, stars)
    return {k: v[1] for k, v in last.items()}


def cf_model(ratings, by, min_overlap=3, min_jaccard=0.0):
    """Positive Pearson pairs; ``by`` is 0 for users, 1 for items."""
    maps = defaultdict(dict)
    for (user, item), stars in latest(ratings).items():
        entity, other = (user, item) if by == 0 else (item, user)
        maps[entity][other] = stars
    model = {}
    for x, y in combinations(sorted(maps), 2):
        common = maps[x].keys() & maps[y].keys()
        if len(common) >= min_overlap and len(common) / len(maps[x].keys() | maps[y].keys()) >= min_jaccard:
            sim = pearson(maps[x], maps[y])
            if sim > 0:
                model[x, y] = round(sim, 9)
    return model


def _nearest(found, top_n):
    """found: (sim, neighbour, stars, value)."""
    return sorted(found, key=lambda f: (-f[0], f[1], f[2]))[:top_n]


def predict_items(targets, ratings, model, top_n):
    held = defaultdict(set)
    for user, item, stars, _ in ratings:
        held[user].add((item, stars))
    out = []
    for user, item in targets:
        found = [
            (model[tuple(sorted((item, other)))], other, stars, stars)
            for other, stars in held[user]
            if tuple(sorted((item, other))) in model
        ]
        best = _nearest(found, top_n)
        top, weight = sum(s * v for s, _, _, v in best), sum(abs(s) for s, *_ in best)
        if top and weight:
            out.append((user, item, round(top / weight, 6)))
    return out


def predict_users(targets, ratings, model, top_n):
    raters, raw = defaultdict(set), defaultdict(list)
    for user, item, stars, _ in ratings:
        raters[item].add((user, stars))
        raw[user].append(stars)
    own = latest(ratings)
    out = []
    for user, item in targets:
        found = []
        for other, stars in raters[item]:
            key = tuple(sorted((user, other)))
            if key not in model:
                continue
            n, total = len(raw[other]), sum(raw[other])
            mean = (total - own[other, item]) / (n - 1) if n > 1 else total / n
            found.append((model[key], other, stars, stars - mean))
        best = _nearest(found, top_n)
        top, weight = round(sum(s * v for s, _, _, v in best), 9), sum(abs(s) for s, *_ in best)
        if top and weight:
            out.append((user, item, round(sum(raw[user]) / len(raw[user]) + top / weight, 6)))
    return out


def skewed_ratings(draw, n_users=40, n_items=60, n_rows=900, hot=3):
    """Random ratings in which ``hot`` users and ``hot`` items hold about two thirds of the rows."""
    made = []
    for order in range(n_rows):
        user = draw.randrange(hot) if draw.random() < 0.4 else draw.randrange(n_users)
        item = draw.randrange(hot) if draw.random() < 0.3 else draw.randrange(n_items)
        made.append((user, item, float(draw.randint(1, 5)), order))
    return made
