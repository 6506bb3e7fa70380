"""Write modes, paging and predicates as plain DataFrame algebra; nothing here touches storage."""
