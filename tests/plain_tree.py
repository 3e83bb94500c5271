"""A Hoeffding tree in plain Python, row by row over one block after the other: what the Spark learner is held against."""

import math

def entropy(d):
    s = sum(d)
    return math.log2(s) - sum(x * math.log2(x) for x in d if x > 0) / s if s > 0 else 0.0

def gini(d):
    s = sum(d)
    return 1 - sum((x / s) ** 2 for x in d) if s > 0 else 1.0

class Plain:
    """The same learner row by row over one block after the other."""

    def __init__(self, nominal, classes, n_features, grace=200, tie=0.05, delta=1e-7, criterion="info_gain", binary_only=False,
                 split_all=False, pre_prune=True, bins=10, track=False):
        self.__dict__.update(locals())
        self.nodes = []
        self.add(None, None, 0, [0.0] * classes)

    def add(self, parent, branch, depth, dist):
        self.nodes.append(dict(parent=parent, branch=branch, depth=depth, kind="active", dist=dist, rows=[], addon=0.0, kids={},
                               feature=None, test=None, value=None, mc=0.0, nb=0.0))

    def route(self, x):
        i = 0
        while self.nodes[i]["kind"] == "split":
            n, v = self.nodes[i], x[self.nodes[i]["feature"]]
            b = (int(v) if v is not None else -1) if n["test"] == "multiway" else 0 if v is not None and (
                v < n["value"] if n["test"] == "numeric" else v == n["value"]) else 1
            if b not in n["kids"]:
                return i
            i = n["kids"][b]
        return i

    def merit(self, post):
        pre = [sum(c) for c in zip(*post)]
        total = sum(pre)
        if self.criterion == "gini":
            return 1 - sum(sum(p) / total * gini(p) for p in post)
        if sum(sum(p) / total > 0.01 for p in post) < 2:
            return -math.inf
        return entropy(pre) - sum(sum(p) / total * entropy(p) for p in post)

    def moments(self, node, f):
        out = {}
        for c in range(self.classes):
            v = [(x[f], w) for x, y, w in node["rows"] if y == c and x[f] is not None and not math.isnan(x[f])]
            fin = [(a, w) for a, w in v if math.isfinite(a)]
            if fin:
                n = sum(w for _, w in fin)
                mean = sum(a * w for a, w in fin) / n
                out[c] = (n, mean, sum(w * (a - mean) ** 2 for a, w in fin), min(a for a, _ in fin), max(a for a, _ in fin))
        return out

    def candidates(self, node, f):
        if f in self.nominal:
            seen = sorted({x[f] for x, _, _ in node["rows"] if x[f] is not None})
            by = {v: [sum(w for x, y, w in node["rows"] if x[f] == v and y == c) for c in range(self.classes)] for v in seen}
            tot = [sum(c) for c in zip(*by.values())] if by else []
            for v in seen:
                yield "nominal", v, [by[v], [t - a for t, a in zip(tot, by[v])]]
            if seen and not self.binary_only:
                yield "multiway", None, [by.get(float(v), [0.0] * self.classes) for v in range(self.nominal[f])]
            return
        g = self.moments(node, f)
        if not g:
            return
        lo, hi = min(m[3] for m in g.values()), max(m[4] for m in g.values())
        for p in sorted({(hi - lo) * i / self.bins + lo for i in range(1, self.bins + 1)}):
            if lo < p < hi:
                left, right = [0.0] * self.classes, [0.0] * self.classes
                for c, (n, mean, m2, mn, mx) in g.items():
                    sd = math.sqrt(m2 / (n - 1)) if n > 1 else 0.0
                    phi = (1 + math.erf((p - mean) / sd / math.sqrt(2))) / 2 if sd > 0 else float(p >= mean)
                    left[c] = 0.0 if p < mn else n if p >= mx else n * phi
                    right[c] = n - left[c]
                yield "numeric", p, [left, right]

    def attempt(self, i):
        n = self.nodes[i]
        if n["kind"] != "active" or n["addon"] < self.grace or sum(d > 0 for d in n["dist"]) <= 1:
            return
        sug = []
        for f in range(self.n_features):
            best = None
            for test, value, post in self.candidates(n, f):
                m = self.merit(post)
                if best is None or round(m, 7) > round(best[0], 7):
                    best = (m, f, test, value, post)
            if best:
                sug.append(best)
        if self.pre_prune:
            s = sum(n["dist"])
            sug.append((-math.inf if self.criterion == "info_gain" else 1 - gini(n["dist"]), 1 << 30, None, None, None))
        sug.sort(key=lambda r: (-r[0], -r[1]))
        if not sug:
            return
        r = math.log2(max(self.classes, 2)) if self.criterion == "info_gain" else 1.0
        bound = math.sqrt(r * r * math.log(1 / self.delta) / (2 * sum(n["dist"])))
        gap = sug[0][0] - sug[1][0] if len(sug) > 1 else math.inf
        if not (bound < self.tie or gap > bound):
            return
        _, f, test, value, post = sug[0]
        if test is None:
            n["kind"] = "inactive"
            return
        n.update(kind="split", feature=f, test=test, value=value, rows=[])
        for b, d in enumerate(post):
            n["kids"][b] = len(self.nodes)
            self.add(i, b, n["depth"] + 1, list(d))

    def model(self, i):
        """What naive Bayes needs of a node: moments and value weights."""
        n = self.nodes[i]
        counts = {(f, c): [sum(w for r, y, w in n["rows"] if y == c and r[f] == v) for v in range(size)]
                  for f, size in self.nominal.items() for c in range(self.classes)}
        return {f: self.moments(n, f) for f in range(self.n_features) if f not in self.nominal}, counts, list(n["dist"])

    def nb_class(self, model, x):
        moments, counts, dist = model
        votes, total = {}, sum(dist)
        for c in range(self.classes):
            ps = []
            for f, g in moments.items():
                if c in g and x[f] is not None and math.isfinite(x[f]):
                    n, mean, m2, _, _ = g[c]
                    sd = math.sqrt(m2 / (n - 1)) if n > 1 else 0.0
                    ps.append(math.exp(-((x[f] - mean) / sd) ** 2 / 2) / (math.sqrt(2 * math.pi) * sd) if sd > 0 else float(x[f] == mean))
            for f, size in self.nominal.items():
                by = counts[f, c]
                if sum(by) > 0:
                    ps.append(((by[int(x[f])] if x[f] is not None else 0.0) + 1) / (sum(by) + size))
            if ps:
                ps.append(dist[c] / total if total else 0.0)
                votes[c] = -math.inf if min(ps) <= 0 else sum(map(math.log10, ps))
        return max(votes, key=lambda c: (votes[c], -c)) if votes else dist.index(max(dist))

    def adaptive(self, x):
        i = self.route(x)
        n = self.nodes[i]
        if n["kind"] == "split" or n["mc"] > n["nb"]:
            return n["dist"].index(max(n["dist"]))
        return self.nb_class(self.model(i), x)

    def fit(self, rows, per_block):
        """rows: (features, label, weight) in order."""
        for at in range(0, len(rows), per_block):
            block = rows[at:at + per_block]
            reached = [self.route(x) for x, _, _ in block]
            models = {i: self.model(i) for i in set(reached) if self.nodes[i]["kind"] == "active"} if self.track else {}
            for i, (x, y, w) in zip(reached, block):
                if i in models and y is not None:
                    dist = models[i][2]
                    self.nodes[i]["mc"] += w * (dist.index(max(dist)) == y)
                    self.nodes[i]["nb"] += w * (self.nb_class(models[i], x) == y)
            for i, row in zip(reached, block):
                if row[1] is not None and self.nodes[i]["kind"] == "active":
                    self.nodes[i]["rows"].append(row)
                    self.nodes[i]["dist"][row[1]] += row[2]
                    self.nodes[i]["addon"] += row[2]
            touched = sorted({i for i, r in zip(reached, block) if r[1] is not None}) if self.split_all else [reached[-1]]
            for i in touched:
                self.attempt(i)
        return self
