"""The layers: bronze, silver, gold, insights, and a run over all of them."""
