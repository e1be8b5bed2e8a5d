"""Common table expressions for the SQL twins."""

from __future__ import annotations


def r(expr: str) -> str:
    """Six digits; the twin of registry.six_digits."""
    return f"round_even(({expr}) * 1e6 + 0.001e0, 0) / 1e6"


def day(expr: str = "date") -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


SPEED = (
    "case when (({us} // 3600000000) % 24) between 7 and 9 or (({us} // 3600000000) % 24) between 17 and 19 "
    "then cast(15 as double) * 1000 / 60 else cast(22 as double) * 1000 / 60 end"
)


def drive(dist: str, us: str) -> str:
    return f"cast(round_even({dist} * 60e6 / ({SPEED.format(us=us)}), 0) as bigint)"


# name -> (tables it reads, definition)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "passes": (
        (),
        """select event_type as route_no, cast(ts as date) as date,
            cast(user_id % 12 + 1 as int) as stop_seq,
            concat('S', cast(user_id % 12 + 1 as varchar)) as stop_id,
            cast(hour(ts) as int) as hour, cast(value as decimal(18,2)) as board,
            cast(regexp_extract(props, '([0-9]+)', 1) as int) as alight,
            cast(2000 + 740 * (user_id % 12) as double) as link_distance_m
        from events""",
    ),
    "dsh": (
        ("passes",),
        """select route_no, date, stop_seq, stop_id, hour, link_distance_m,
            count(*) as ops, cast(sum(board) as double) as board, cast(sum(alight) as double) as alight,
            concat('Stop ', cast(stop_seq as varchar)) as stop_name
        from passes group by 1, 2, 3, 4, 5, 6""",
    ),
    "hours": ((), "select cast(range as int) as hour from range(24)"),
    "grid": (
        ("dsh", "hours"),
        """select d.route_no, d.date, d.stop_id, d.stop_seq, h.hour, o.ops
        from (select distinct route_no, date, stop_id, stop_seq from dsh) d
        cross join hours h
        left join dsh o on o.route_no = d.route_no and o.date = d.date
            and o.stop_id = d.stop_id and o.hour = h.hour""",
    ),
    "daily": (
        ("passes",),
        """select date, concat('R-', route_no) as rte_id, route_no, stop_id,
            concat('Stop ', cast(stop_seq as varchar)) as stop_name,
            cast(floor(sum(board)) as bigint) as board_total, cast(sum(alight) as bigint) as alight_total,
            date + 3 as reg_ymd
        from passes group by date, route_no, stop_id, stop_seq""",
    ),
    "monthly": (
        ("passes",),
        """select strftime(date, '%Y%m') as use_ym, route_no, stop_id, stop_seq, hour,
            concat('Stop ', cast(stop_seq as varchar)) as stop_name,
            cast(floor(sum(board)) as bigint) as board_total, cast(sum(alight) as bigint) as alight_total
        from passes group by 1, route_no, stop_id, stop_seq, hour""",
    ),
    "weights": (
        ("monthly",),
        """select use_ym, route_no, stop_id, hour,
            case when sum(board_total) over w > 0
                then board_total / cast(sum(board_total) over w as double)
                else cast(1 as double) / 24 end as w_board,
            case when sum(alight_total) over w > 0
                then alight_total / cast(sum(alight_total) over w as double)
                else cast(1 as double) / 24 end as w_alight
        from monthly window w as (partition by use_ym, route_no, stop_id)""",
    ),
    "estimated": (
        ("grid", "daily", "weights"),
        """select g.date, g.route_no, concat('R-', g.route_no) as rte_id, g.stop_id, g.stop_seq, g.hour,
            coalesce(g.ops, 0) as ops, d.stop_name,
            coalesce(d.board_total, 0) * coalesce(w.w_board, cast(1 as double) / 24) as board,
            coalesce(d.alight_total, 0) * coalesce(w.w_alight, cast(1 as double) / 24) as alight
        from grid g
        left join daily d on d.date = g.date and d.route_no = g.route_no and d.stop_id = g.stop_id
        left join weights w on w.use_ym = strftime(g.date, '%Y%m') and w.route_no = g.route_no
            and w.stop_id = g.stop_id and w.hour = g.hour""",
    ),
    "links": (
        ("passes",),
        """select distinct concat('R-', route_no) as route_key, route_no,
            case when stop_seq in (4, 8, 12) then concat('X', cast(stop_seq as varchar)) else stop_id end as stop_id,
            stop_seq,
            case when stop_seq = 5 then 0 when stop_seq <> 7 then link_distance_m end as link_distance_m
        from passes""",
    ),
    "link_seq": (
        ("links",),
        "select route_no, stop_seq, avg(link_distance_m) as d from links group by 1, 2",
    ),
    "link_mean": (
        ("link_seq",),
        "select route_no, avg(d) filter (where stop_seq <> 1 and d <> 0) as mean from link_seq group by 1",
    ),
    "link_clean": (
        ("link_seq", "link_mean"),
        """select s.route_no, s.stop_seq, m.mean,
            case when s.stop_seq = 1 then 0 when s.d > 0 then s.d else m.mean end as d
        from link_seq s join link_mean m on m.route_no = s.route_no""",
    ),
    "preds": (
        ("dsh",),
        """select route_no, date, hour, stop_id, stop_seq, stop_name, ops * cast(1.25 as double) as pass_buses,
            board as pred_board, alight as pred_alight,
            board / (ops * cast(1.25 as double)) as board_per_bus,
            alight / (ops * cast(1.25 as double)) as alight_per_bus
        from dsh""",
    ),
    "profile": (
        ("preds", "link_clean", "link_mean"),
        """select s.route_no, s.date, s.stop_seq, s.stop_id, s.stop_name,
            coalesce(l.d, m.mean, case when s.stop_seq = 1 then 0 else 300 end) as link_distance_m,
            row_number() over (partition by s.route_no, s.date order by s.stop_seq) as pos
        from (select route_no, date, stop_seq, min(stop_id) as stop_id, min(stop_name) as stop_name
            from preds group by 1, 2, 3) s
        left join link_clean l on l.route_no = s.route_no and l.stop_seq = s.stop_seq
        left join link_mean m on m.route_no = s.route_no""",
    ),
    "deps": (
        ("preds",),
        """select route_no, date, hour, n, k,
            printf('%s-%02d-%02d', strftime(date, '%Y%m%d'), hour, k + 1) as bus_id,
            cast(60 as double) / n as headway_min,
            cast(hour as bigint) * 3600000000
                + cast(round_even(cast(60 as double) / n * k * 60e6, 0) as bigint) as departure_us
        from (select route_no, date, hour, n, unnest(range(n)) as k
            from (select route_no, date, hour, cast(round_even(sum(pass_buses), 0) as bigint) as n
                from preds where stop_seq = 1 group by 1, 2, 3))""",
    ),
    "arrivals": (
        ("deps", "profile"),
        f"""select d.route_no, d.date, d.bus_id, d.departure_us, p.pos, p.stop_seq, p.stop_id, p.stop_name,
            case when p.stop_seq = 1 then d.departure_us
                else d.departure_us + {drive('p.link_distance_m', 'd.departure_us')} end as arrival_us
        from deps d join profile p on p.route_no = d.route_no and p.date = d.date and p.pos = 1
        union all
        select a.route_no, a.date, a.bus_id, a.departure_us, p.pos, p.stop_seq, p.stop_id, p.stop_name,
            case when p.stop_seq = 1 then a.departure_us
                else a.arrival_us + {drive('p.link_distance_m', 'a.arrival_us')} end
        from arrivals a join profile p on p.route_no = a.route_no and p.date = a.date and p.pos = a.pos + 1""",
    ),
    "shares": (
        ("arrivals", "preds"),
        """select b.*, t.board_total, t.alight_total,
            greatest(coalesce(t.board_total / b.n, 0), 0) as board_per_bus,
            greatest(coalesce(t.alight_total / b.n, 0), 0) as alight_per_bus
        from (select route_no, date, stop_seq, arrival_us // 3600000000 as bucket, count(*) as n
            from arrivals group by 1, 2, 3, 4) b
        left join (select route_no, date, stop_seq, hour, sum(pred_board) as board_total,
                sum(pred_alight) as alight_total from preds group by 1, 2, 3, 4) t
            on t.route_no = b.route_no and t.date = b.date and t.stop_seq = b.stop_seq and t.hour = b.bucket""",
    ),
    "plan": (
        ("passes",),
        """select route_no, date, hour, count(*) as n, cast(sum(board) as double) as l
        from passes group by 1, 2, 3""",
    ),
    "needs": (
        ("plan",),
        """select *, case when open then greatest(n - need, 0) else 0 end as spare,
            case when open then greatest(need - n, 0) else 0 end as deficit
        from (select *, cast(greatest(ceil(l / 49.5), 1) as bigint) as need,
                hour >= min(hour) over w + 3 and hour <= max(hour) over w - 3 as open
            from plan window w as (partition by route_no, date))""",
    ),
    "moves": (
        ("needs",),
        """select d.route_no, d.date, d.hour as from_hour, c.hour as to_hour,
            printf('%s-%02d-%02d', strftime(d.date, '%Y%m%d'), d.hour, d.n - d.unit) as move_bus_id
        from (select *, row_number() over (partition by route_no, date order by spare desc, hour, unit) as i
            from (select *, unnest(range(spare)) as unit from needs)) d
        join (select *, row_number() over (partition by route_no, date order by deficit desc, hour, unit) as i
            from (select *, unnest(range(deficit)) as unit from needs)) c
            on c.route_no = d.route_no and c.date = d.date and c.i = d.i""",
    ),
    "after": (
        ("plan", "moves"),
        """select p.route_no, p.date, p.hour, p.n, p.n - coalesce(o.c, 0) + coalesce(i.c, 0) as n_new
        from plan p
        left join (select route_no, date, from_hour, count(*) as c from moves group by 1, 2, 3) o
            on o.route_no = p.route_no and o.date = p.date and o.from_hour = p.hour
        left join (select route_no, date, to_hour, count(*) as c from moves group by 1, 2, 3) i
            on i.route_no = p.route_no and i.date = p.date and i.to_hour = p.hour""",
    ),
    "features": (
        ("dsh",),
        """select d.route_no, d.stop_id, d.date, d.hour, date_diff('day', date '1970-01-01', d.date) * 24 + d.hour as hour_index,
            isodow(d.date) - 1 as dow, case when isodow(d.date) >= 6 then 1 else 0 end as is_weekend, d.stop_seq,
            coalesce(case when d.link_distance_m <> 0 then d.link_distance_m end, m.mean, 300) as distance,
            cast(d.ops as double) as pass_buses,
            least(greatest(cast(60 as double) / d.ops, 2), 60) as headway_min, cast(49.5 as double) as target_per_bus,
            greatest(d.board, 0) as y_board, greatest(d.alight, 0) as y_alight
        from dsh d
        join (select route_no, avg(link_distance_m) filter (where link_distance_m <> 0) as mean
            from dsh group by 1) m on m.route_no = d.route_no""",
    ),
    "split_rows": (
        ("features",),
        """select * from (select *, case when date <= date '2024-01-19' then 'train'
            when date between date '2024-01-20' and date '2024-01-21' then 'val'
            when date >= date '2024-01-22' then 'test' end as split
        from features) where split is not null""",
    ),
}


def twin(body: str, *tables: str, extra: str = "") -> str:
    """`body` behind the expressions it names and whatever those read."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for t in tables:
        visit(t)
    parts = [f"{n} as ({CTES[n][1]})" for n in order]
    if extra:
        parts.append(extra)
    return f"with recursive {', '.join(parts)} {body}" if parts else body


