"""DataFrame operators: rules, snapshot, matching, actions, sync."""
