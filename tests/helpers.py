"""Small-fixture builders and a brute-force as-of reference."""

from datetime import datetime, timezone

EPOCH = datetime(1970, 1, 1)


def us(dt: datetime) -> int:
    if dt.tzinfo is not None:
        dt = dt.astimezone(timezone.utc).replace(tzinfo=None)
    d = dt - EPOCH
    return (d.days * 86400 + d.seconds) * 1_000_000 + d.microseconds


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def _key(v):
    return (0, 0) if v is None else (1, v)


def brute_asof(spine, source, ttl_us, has_created, keep_unmatched=False):
    """spine: [(k, t_us)]; source: [(k, ts_us, created_us, f)] -> {(k, t): f}.

    Latest source row with equal non-null key and t - ttl <= ts <= t, ranked
    by (created, ts, f), NULL lowest."""
    out = {}
    for k, t in set(spine):
        cands = []
        for sk, ts, cr, f in source:
            if k is None or sk is None or sk != k or ts is None or t is None:
                continue
            if ttl_us is not None and not (t - ttl_us <= ts <= t):
                continue
            rank = ((_key(cr),) if has_created else ()) + (_key(ts), _key(f))
            cands.append((rank, f))
        if cands:
            out[(k, t)] = max(cands)[1]
        elif keep_unmatched or ttl_us is None:
            out[(k, t)] = None
    return out


def plan_text(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()
