"""Rows that the operators of an executed plan put out."""


def largest_output(df) -> int:
    """Run ``df`` and return the largest row count that any operator of its final plan put out."""
    df.collect()
    best, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            best = max(best, metric.get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return best
