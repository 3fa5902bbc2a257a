"""Stepwise columns.

A long column expression that uses its parts several times grows beyond all
bounds: the optimizer writes projected columns out wherever filters and joins
above refer to them. ``in_steps`` computes each step in a lateral view of one
row per row. Such columns are never written out, so every step is evaluated
once and the plan stays small.
"""


def in_steps(df, *steps):
    """Add the columns of each step (a dict of name to SQL text) in turn.

    Columns whose name starts with '_' serve later steps and are dropped.
    """
    views = []
    for i, step in enumerate(steps):
        row = ", ".join(f"{text} AS `{name}`" for name, text in step.items())
        names = ", ".join(f"`{name}`" for name in step)
        views.append(f"LATERAL VIEW inline(array(struct({row}))) step{i} AS {names}")
    temporary = ", ".join(name for step in steps for name in step if name.startswith("_"))
    columns = f"* EXCEPT ({temporary})" if temporary else "*"
    # Braces of regular expressions are no placeholders.
    text = "\n".join(views).replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT {columns} FROM {{rows}} rows {text}", rows=df)


def cases(*pairs, otherwise=None):
    """CASE text: pairs of condition and value."""
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in pairs)
    return f"CASE {whens}{f' ELSE {otherwise}' if otherwise is not None else ''} END"
