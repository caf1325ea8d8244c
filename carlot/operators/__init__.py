"""DataFrame operators: cleaning, hierarchy, pricing, masks and scores."""
