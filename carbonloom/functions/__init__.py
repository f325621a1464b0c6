"""Pure Column functions: no joins, no aggregates, all inside whole-stage codegen."""
