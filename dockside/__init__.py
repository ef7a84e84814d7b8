"""dockside: purchase-order analytics and table upkeep as Spark jobs."""
