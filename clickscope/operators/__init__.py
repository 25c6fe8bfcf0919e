"""Query building blocks, one module per business area."""
